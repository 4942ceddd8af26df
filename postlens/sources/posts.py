"""Reading posts: streams, archives, and the two platform formats brought to one layout."""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.schemas import RAW_POST, WIRE_POST


def read_raw_stream(
    spark: SparkSession,
    servers: str,
    topic: str = "social-raw-stream",
    max_per_trigger: int | None = None,
    starting: str = "latest",
) -> DataFrame:
    """Messages of a Kafka topic as (value, received_at). Needs the Kafka connector package.

    A batch takes all messages there are, unless max_per_trigger bounds it.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(
        F.col("value").cast("string").alias("value"), F.col("timestamp").alias("received_at")
    )


def read_raw_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same stream from a folder of JSON-lines files, one message per line."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def parse_time(text: Column) -> Column:
    """ISO-8601 text to a timestamp; NULL when it is not one."""
    return F.try_to_timestamp(text)


def typed(wire: DataFrame) -> DataFrame:
    """Wire layout to the raw layout: the time is parsed, missing maps become empty."""
    return wire.select(
        *[
            parse_time(F.col(f.name)).alias(f.name)
            if f.name == "created_at"
            else F.coalesce(f.name, F.from_json(F.lit("{}"), f.dataType)).alias(f.name)
            if f.name in ("engagement", "raw_metadata")
            else F.col(f.name)
            for f in WIRE_POST
        ]
    )


def read_archive(spark: SparkSession, path: str, layout: dict[str, str] | None = None) -> DataFrame:
    """A JSON-lines archive (plain, gzip or bz2) as raw posts of platform twitter_archive.

    layout maps raw columns to SQL expressions over the archive's own fields; by default the
    archive already has the wire layout.
    """
    if layout is None:
        posts = typed(spark.read.schema(WIRE_POST).json(path))
        return posts.withColumn("platform", F.lit("twitter_archive"))
    lines = spark.read.text(path).select(F.parse_json("value").alias("v"))
    chosen = []
    for f in RAW_POST:
        if f.name == "platform":
            chosen.append(F.lit("twitter_archive").alias("platform"))
        elif f.name in layout:
            chosen.append(F.expr(layout[f.name]).cast(f.dataType).alias(f.name))
        else:
            chosen.append(F.lit(None).cast(f.dataType).alias(f.name))
    return lines.select(*chosen)


def write_replay(posts: DataFrame, path: str, rows_per_file: int) -> None:
    """History as time-ordered files for `read_replay`, at most rows_per_file rows in each.

    The range partitioning spreads the sort over all tasks; file names keep the time order.
    """
    posts.sort("created_at").write.option("maxRecordsPerFile", rows_per_file).mode(
        "overwrite"
    ).parquet(path)


def read_replay(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """Replay: with a trigger of n seconds the rate is files_per_trigger * rows_per_file / n."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(path)
    )


BLUESKY_PATH = "app.bsky.feed.post"


def normalize_bluesky(commits: DataFrame) -> DataFrame:
    """Decoded repository commits to raw posts: one post per create operation on a feed post.

    The parent's id gets the same prefix as post ids, so that a reply finds its post.
    """
    did = F.coalesce("repo", F.lit("unknown_did"))
    return (
        commits.select(did.alias("did"), F.explode("ops").alias("op"))
        .filter((F.col("op.action") == "create") & F.startswith("op.path", F.lit(BLUESKY_PATH)))
        .select(
            "did",
            F.element_at(F.split("op.path", "/"), -1).alias("rkey"),
            F.col("op.record").alias("record"),
        )
        .select(
            F.concat(F.lit("bsky_"), "rkey").alias("post_id"),
            F.lit("bluesky").alias("platform"),
            F.col("did").alias("author_id"),
            F.concat(F.left("did", F.lit(16)), F.lit(".bsky.social")).alias("author_handle"),
            F.coalesce("record.text", F.lit("")).alias("text"),
            F.coalesce(parse_time(F.col("record.createdAt")), F.current_timestamp()).alias(
                "created_at"
            ),
            F.concat(
                F.lit("https://bsky.app/profile/"), "did", F.lit("/post/"), "rkey"
            ).alias("url"),
            F.concat(
                F.lit("bsky_"), F.element_at(F.split("record.reply.parent.uri", "/"), -1)
            ).alias("reply_to_id"),
            F.lit(None).cast("string").alias("reply_to_user"),
            F.create_map(
                *[x for k in ("likes", "reposts", "replies") for x in (F.lit(k), F.lit(0).cast("bigint"))]
            ).alias("engagement"),
            F.create_map(F.lit("source"), F.lit("firehose_commit")).alias("raw_metadata"),
        )
    )


def normalize_reddit(items: DataFrame) -> DataFrame:
    """Forum comments and submissions to raw posts.

    A parent id may carry a type tag (t1_ for comments, t3_ for submissions); it is dropped so
    that a reply finds its post. A submission answers nothing.
    """
    comment = F.col("kind") == "comment"
    author = F.coalesce("author", F.lit("[deleted]"))
    parent = F.when(comment, F.regexp_replace("parent_id", "^t[0-9]_", ""))
    zero = F.lit(0).cast("bigint")
    return items.select(
        F.concat(F.lit("reddit_"), "id").alias("post_id"),
        F.lit("reddit").alias("platform"),
        F.concat(F.lit("reddit_u_"), author).alias("author_id"),
        F.concat(F.lit("u/"), author).alias("author_handle"),
        F.when(comment, F.col("body"))
        .otherwise(
            F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), F.coalesce("selftext", F.lit("")))
        )
        .alias("text"),
        F.timestamp_seconds("created_utc").alias("created_at"),
        F.when(comment, F.concat(F.lit("https://reddit.com"), "permalink"))
        .otherwise(F.col("url"))
        .alias("url"),
        F.concat(F.lit("reddit_"), F.nullif(parent, F.lit(""))).alias("reply_to_id"),
        F.lit(None).cast("string").alias("reply_to_user"),
        F.create_map(
            F.lit("score"),
            F.col("score"),
            F.lit("likes"),
            F.greatest(zero, F.col("score")),
            F.lit("reposts"),
            zero,
            F.lit("replies"),
            zero,
        ).alias("engagement"),
        F.create_map(F.lit("subreddit"), F.col("subreddit"), F.lit("source"), F.lit("forum_stream")).alias(
            "raw_metadata"
        ),
    )


def union_platforms(*posts: DataFrame) -> DataFrame:
    """All platforms in one DataFrame; a column one of them lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), posts)
