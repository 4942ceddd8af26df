"""Exploration of raw text: shares, lengths, emoji, hashtags, bursts."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postlens.functions import emoji
from postlens.functions.numeric import percent, rounded, row_count
from postlens.functions.text import HASHTAG, raw_word_count
from postlens.operators.filters import has_keyword
from postlens.session import cut_lineage


def share_of_voice(posts: DataFrame) -> DataFrame:
    """Posts per platform and percentage of all; the window sees one row per platform."""
    counted = posts.groupBy("platform").agg(row_count().alias("posts"))
    return counted.withColumn(
        "share_pct", percent(F.col("posts"), F.sum("posts").over(W.partitionBy()), 1)
    )


def text_length_stats(posts: DataFrame, text: str = "text") -> DataFrame:
    """Quartiles of characters and words per platform.

    The exact percentile keeps one counter per distinct length, not per post.
    """
    lengths = posts.select(
        "platform",
        F.char_length(text).alias("chars"),
        raw_word_count(F.col(text)).alias("words"),
    )
    stats = []
    for name in ("chars", "words"):
        stats.append(F.min(name).cast("bigint").alias(f"{name}_min"))
        for label, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75)):
            stats.append(rounded(F.percentile(name, q), 4).alias(f"{name}_{label}"))
        stats.append(F.max(name).cast("bigint").alias(f"{name}_max"))
    return lengths.groupBy("platform").agg(row_count().alias("posts"), *stats)


def length_density(posts: DataFrame, text: str = "text", width: int = 25) -> DataFrame:
    """Share of each platform's texts per band of word counts; the window sees one row per band."""
    band = (F.floor(raw_word_count(F.col(text)) / width) * width).cast("bigint")
    counted = posts.groupBy("platform", band.alias("words_from")).agg(row_count().alias("texts"))
    whole = F.sum("texts").over(W.partitionBy("platform"))
    return counted.withColumn("share_pct", percent(F.col("texts"), whole, 4))


def sequence_length_stats(
    posts: DataFrame, text: str = "text", bins: int = 20, cap: int = 128
) -> DataFrame:
    """Word counts (not model tokens) in equal-width bins, and the share of texts above cap.

    The texts are read once: range, bins and share all come from the table of distinct lengths.
    """
    counted = cut_lineage(
        posts.groupBy(raw_word_count(F.col(text)).alias("words")).agg(row_count().alias("n"))
    )
    low, high = counted.agg(F.min("words")).scalar(), counted.agg(F.max("words")).scalar()
    over = F.sum(F.when(F.col("words") > cap, F.col("n")).otherwise(0))
    width = F.greatest(F.lit(1.0), (high - low) / F.lit(float(bins)))
    slot = F.least(F.lit(bins - 1), F.floor((F.col("words") - low) / width)).cast("bigint")
    return (
        counted.groupBy(slot.alias("bin"))
        .agg(
            F.sum("n").alias("texts"),
            F.min("words").cast("bigint").alias("shortest"),
            F.max("words").cast("bigint").alias("longest"),
        )
        .withColumn("over_cap_pct", counted.agg(percent(over, F.sum("n"), 4)).scalar())
    )


def spam_reason_breakdown(graded: DataFrame) -> DataFrame:
    """Spam posts per reason. Filtered after the counts: a filter below them would find the reasons a second time."""
    spam = graded.groupBy("spam_reason").agg(F.count_if("is_spam").alias("posts"))
    return spam.filter("posts > 0")


def emoji_rows(posts: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per emoji in a text. ASCII texts, as long in bytes as in characters, hold none."""
    beyond_ascii = F.octet_length(text) > F.char_length(text)
    signs = F.regexp_replace(F.col(text), r"[\x00-\x7F]+", "")
    found = F.regexp_extract_all(signs, F.lit(emoji.java_class()), F.lit(0))
    return posts.filter(beyond_ascii).select(*keep, F.explode(found).alias("emoji"))


def named(counted: DataFrame) -> DataFrame:
    """Add emoji names from the fixed table of about 1,400 code points."""
    spark = counted.sparkSession
    names = spark.createDataFrame(emoji.name_table(), "emoji string, emoji_name string")
    return counted.join(F.broadcast(names), "emoji", "left")


def emoji_frequency(posts: DataFrame, text: str = "raw_text", k: int = 10) -> DataFrame:
    """The k most used emoji with their names."""
    counted = emoji_rows(posts, text).groupBy("emoji").agg(row_count().alias("uses"))
    return named(counted).orderBy(F.desc("uses"), "emoji").limit(k)


def emoji_polarity(posts: DataFrame, text: str = "clean_text") -> DataFrame:
    """Uses of each emoji by sentiment label of the post, and the mean score around it."""
    counted = (
        emoji_rows(posts, text, "sentiment_label", "sentiment_score")
        .groupBy("emoji")
        .agg(
            row_count().alias("uses"),
            *[
                F.count_if(F.col("sentiment_label") == label).alias(f"{label}_uses")
                for label in ("positive", "neutral", "negative")
            ],
            rounded(F.avg("sentiment_score"), 4).alias("mean_score"),
        )
    )
    return named(counted)


def hashtag_cooccurrence(
    posts: DataFrame, brand_terms: list[str], keywords: list[str], text: str = "raw_text"
) -> DataFrame:
    """brand_term, tag, posts: hashtags and keywords in posts that name the brand.

    A post yields its distinct tags once per brand term it holds, so rows grow with the text.
    """
    body = F.col(text)
    tags = F.transform(
        F.regexp_extract_all(body, F.lit(HASHTAG), F.lit(1)),
        lambda t: F.concat(F.lit("#"), F.lower(t)),
    )
    spoken = F.filter(
        F.array(*[F.lit(k.lower()) for k in keywords]),
        lambda k: F.contains(F.lower(body), k),
    )
    brands = F.filter(
        F.array(*[F.lit(b.lower()) for b in brand_terms]),
        lambda b: F.contains(F.lower(body), b),
    )
    return (
        posts.filter(has_keyword(body, brand_terms))
        .select(
            F.explode(brands).alias("brand_term"), F.array_distinct(F.concat(tags, spoken)).alias("t")
        )
        .select("brand_term", F.explode("t").alias("tag"))
        .filter(F.col("tag") != F.col("brand_term"))
        .groupBy("brand_term", "tag")
        .agg(row_count().alias("posts"))
    )


def hourly_velocity(posts: DataFrame) -> DataFrame:
    """Posts per hour; hours without posts between the first and the last count 0."""
    counted = posts.groupBy(F.date_trunc("hour", "created_at").alias("hour")).agg(
        row_count().alias("n")
    )
    span = counted.agg(F.min("hour").alias("a"), F.max("hour").alias("b"))
    hours = span.filter(F.col("a").isNotNull()).select(
        F.explode(F.sequence("a", "b", F.expr("interval 1 hour"))).alias("hour")
    )
    return (
        hours.join(counted, "hour", "left")
        .select("hour", F.coalesce("n", F.lit(0)).alias("posts"))
        .orderBy("hour")
    )
