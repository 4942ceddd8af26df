"""The daily job: check, roll up, find topics, score influence, write the report."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators.filters import on_day, topic_corpus
from postlens.operators.graph import run_influence
from postlens.operators.metrics import daily_rollup
from postlens.operators.topics import discover_topics, keyword_frame, topic_clusters
from postlens.plans.report import daily_report
from postlens.sources.sinks import KeyedTable, append_snapshot, replace_days


def metric_table(root: str) -> KeyedTable:
    return KeyedTable(
        f"{root}/sentiment_metrics_timeseries",
        ["granularity", "platform", "window_start"],
        time="window_start",
    )


def topic_table(root: str) -> KeyedTable:
    return KeyedTable(f"{root}/topic_clusters", ["run_date", "topic_id"], time="run_date")


def influence_path(root: str) -> str:
    return f"{root}/user_influence_scores"


def refresh_metrics(posts: DataFrame, day, root: str) -> None:
    """Gold rows of one day; a rerun replaces them whole."""
    replace_days(metric_table(root), daily_rollup(posts, day))


def refresh_topics(posts: DataFrame, day, root: str, **options) -> None:
    corpus = topic_corpus(posts, day)
    assigned, terms = discover_topics(corpus, **options)
    if not terms:
        return
    joined = corpus.join(assigned, "post_id")
    keywords = keyword_frame(posts.sparkSession, terms)
    replace_days(topic_table(root), topic_clusters(joined, keywords, day))


def refresh_influence(raw: DataFrame, posts: DataFrame, as_of, root: str, **options) -> None:
    append_snapshot(influence_path(root), run_influence(raw, posts, 7, as_of, **options), as_of)


def run_daily(
    spark: SparkSession,
    raw: DataFrame,
    posts: DataFrame,
    aspects: DataFrame,
    alerts: DataFrame,
    day,
    as_of,
    root: str,
    min_posts: int = 1,
) -> DataFrame | None:
    """All steps for one day; the report row, or None when the day has too few posts."""
    if on_day(posts, day).limit(min_posts).count() < min_posts:
        return None
    refresh_metrics(posts, day, root)
    refresh_topics(posts, day, root)
    refresh_influence(raw, posts, as_of, root)
    clusters = topic_table(root).read(spark)
    if clusters is None:
        clusters = spark.createDataFrame(
            [],
            "run_date date, topic_id int, topic_label string, top_keywords array<string>, "
            "post_count bigint, positive_ratio double, negative_ratio double, "
            "mean_sentiment double, representative_samples array<string>",
        )
    scores = spark.read.parquet(influence_path(root))
    newest = clusters.filter(F.col("run_date") == F.lit(str(day)).cast("date"))
    return daily_report(posts, raw, aspects, alerts, scores, newest, day)
