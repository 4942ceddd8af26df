"""Posts made from the given star-schema tables, so that every query has real rows to run on.

Every rule is row-wise arithmetic on one source table: no shuffle, and filters on created_at
reach the Parquet scan because ts is read as a timestamp with the stored values.
"""

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.schemas import ASPECTS, LABELS
from postlens.session import small_batches, spread

SOURCE_COLUMNS = {
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, "
    "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

# Events lie in January 2024; queries that look back from "now" use this moment.
AS_OF = "2024-01-31 00:00:00"
LAST_DAY = "2024-01-30"


def source_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in SOURCE_COLUMNS:
        reader = reader.schema(SOURCE_COLUMNS[name])
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def platform_of(number):
    """35 / 45 / 20 split over the three platforms, fixed per author."""
    slot = F.pmod(number, F.lit(20))
    return F.when(slot < 7, "bluesky").when(slot < 16, "reddit").otherwise("twitter_archive")


def label_of(score):
    """The label whose score this is: -1, 0 or 1."""
    return F.element_at(F.array(*[F.lit(x) for x in LABELS]), (score + 2).cast("int"))


class Tables:
    """Bronze, silver and aspect tables over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def source(self, name: str) -> DataFrame:
        return source_table(self.spark, self.sf_dir, name)

    def texts(self, name: str) -> DataFrame:
        """A table of long texts, with enough tasks for work on its words and small batches for Python."""
        small_batches(self.spark)
        return spread(self.source(name))

    def raw_posts(self) -> DataFrame:
        """Bronze: replies point a few posts back; some engagement maps lack `replies`."""
        k = F.get_json_object("props", "$.k").cast("bigint")
        parent = F.col("event_id") - 1 - F.col("event_id") % 7
        likes_reposts = F.create_map(F.lit("likes"), k, F.lit("reposts"), k % 10)
        replies = F.create_map(F.lit("replies"), k % 5)
        return self.source("events").select(
            F.col("event_id").cast("string").alias("post_id"),
            platform_of(F.col("user_id")).alias("platform"),
            F.concat(F.lit("u"), "user_id").alias("author_id"),
            F.concat(F.lit("@"), "user_id").alias("author_handle"),
            self.event_text().alias("raw_text"),
            F.concat(F.lit("https://posts.example/"), "event_id").alias("url"),
            F.col("ts").alias("created_at"),
            F.when((F.col("event_id") % 3 == 0) & (parent >= 0), parent.cast("string")).alias(
                "reply_to_id"
            ),
            F.lit(None).cast("string").alias("reply_to_user"),
            F.when(k % 4 == 0, likes_reposts)
            .otherwise(F.map_concat(likes_reposts, replies))
            .alias("engagement"),
            F.create_map(F.lit("source"), F.col("event_type")).alias("raw_metadata"),
        )

    def sentiment_posts(self) -> DataFrame:
        """Silver: score from value, with a drop in mood from 15 to 17 January."""
        shock = (F.col("ts") >= F.lit("2024-01-15").cast("timestamp")) & (
            F.col("ts") < F.lit("2024-01-18").cast("timestamp")
        )
        value = F.col("value")
        score = (
            F.when(shock, F.when(value < 40, -1).otherwise(1))
            .when(value < 14, -1)
            .when(value < 30, 0)
            .otherwise(1)
        )
        return self.source("events").select(
            F.col("event_id").cast("string").alias("post_id"),
            platform_of(F.col("user_id")).alias("platform"),
            F.concat(F.lit("u"), "user_id").alias("author_id"),
            F.concat(F.lit("@"), "user_id").alias("author_handle"),
            self.event_text().alias("clean_text"),
            F.lit("en").alias("language"),
            label_of(score).alias("sentiment_label"),
            score.cast("double").alias("sentiment_score"),
            (0.5 + (F.col("event_id") % 50) / 100).alias("confidence"),
            (F.col("event_id") % 12 == 0).alias("is_spam"),
            F.col("ts").alias("created_at"),
        )

    def aspects(self) -> DataFrame:
        """One row per (post, aspect), with the post's time."""
        score = (F.col("event_id") + F.col("ix")) % 3 - 1
        return (
            self.source("events")
            .select(
                "event_id",
                "user_id",
                "ts",
                F.posexplode(F.array(*[F.lit(a) for a in ASPECTS])).alias("ix", "aspect"),
            )
            .select(
                F.col("event_id").cast("string").alias("post_id"),
                platform_of(F.col("user_id")).alias("platform"),
                "aspect",
                label_of(score).alias("sentiment_label"),
                score.cast("double").alias("sentiment_score"),
                (0.5 + ((F.col("event_id") + F.col("ix")) % 50) / 100).alias("confidence"),
                F.col("ts").alias("created_at"),
            )
        )

    def document_posts(self) -> DataFrame:
        """Posts with long real texts; label and score follow doc_id."""
        score = F.col("doc_id") % 3 - 1
        return self.texts("documents").select(
            F.col("doc_id").cast("string").alias("post_id"),
            platform_of(F.col("doc_id")).alias("platform"),
            "text",
            "lang",
            label_of(score).alias("sentiment_label"),
            score.cast("double").alias("sentiment_score"),
        )

    def conversation_posts(self) -> DataFrame:
        """Chat turns as posts that answer the turn before."""
        key = F.concat_ws("-", "conv_id", "turn")
        parent = F.concat_ws("-", "conv_id", F.col("turn") - 1)
        return self.texts("conversations").select(
            key.alias("post_id"),
            platform_of(F.col("conv_id")).alias("platform"),
            F.concat_ws("_", "role", "conv_id").alias("author_id"),
            "text",
            F.when(F.col("turn") > 0, parent).alias("reply_to_id"),
        )

    @staticmethod
    def event_text():
        return F.concat(
            F.lit("a #"),
            F.col("event_type"),
            F.lit(" report from @"),
            F.floor(F.col("user_id") / 2),
            F.lit(" on case "),
            F.get_json_object("props", "$.k"),
            F.when(F.col("event_type") == "error", " 😡")
            .when(F.col("event_type") == "purchase", " 🚀🚀")
            .when(F.col("event_type") == "signup", " ✨")
            .otherwise(""),
        )
