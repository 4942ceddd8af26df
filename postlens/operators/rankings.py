"""Top-k reports. Each sorts by its measure and then by key, so ties come out the same way."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.numeric import percent, rounded
from postlens.operators.filters import lookback
from postlens.operators.metrics import last, with_engagement


def latest(df: DataFrame, column: str) -> DataFrame:
    """Rows of the newest snapshot; the newest value is a scalar subquery."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def viral_negative_posts(posts: DataFrame, raw: DataFrame, as_of=None, k: int = 15) -> DataFrame:
    """Negative posts of the last day by likes + 2 reposts + 3 replies. Spam counts here."""
    negative = posts.filter(F.col("sentiment_label") == "negative")
    kinds = {
        kind: F.coalesce(F.col("engagement")[kind], F.lit(0).cast("bigint"))
        for kind in ("likes", "reposts", "replies")
    }
    impact = kinds["likes"] + 2 * kinds["reposts"] + 3 * kinds["replies"]
    return (
        with_engagement(negative, raw, last("24 hours", as_of))
        .select(
            "post_id",
            "platform",
            "author_handle",
            F.left("clean_text", F.lit(120)).alias("snippet"),
            "sentiment_score",
            "confidence",
            *[column.alias(kind) for kind, column in kinds.items()],
            impact.alias("impact_weight"),
            "created_at",
        )
        .orderBy(F.desc("impact_weight"), "platform", "post_id")
        .limit(k)
    )


def riskiest(scores: DataFrame, k: int) -> DataFrame:
    return scores.orderBy(F.desc("amplification_risk_score"), "platform", "author_id").limit(k)


def recent_amplifiers(scores: DataFrame, as_of=None, k: int = 50) -> DataFrame:
    """Highest risk among snapshots of the last 48 hours."""
    return riskiest(lookback(scores, "48 hours", as_of, "calculated_at"), k).select(
        "author_id",
        "author_handle",
        "platform",
        "pagerank_score",
        "total_posts",
        "negative_posts",
        "amplification_risk_score",
        "calculated_at",
    )


def detractor_amplifiers(scores: DataFrame, k: int = 10, min_negative: int = 2) -> DataFrame:
    """Highest risk in the newest snapshot among authors with enough negative posts."""
    newest = latest(scores, "calculated_at").filter(F.col("negative_posts") > min_negative)
    return riskiest(newest, k).select(
        "author_id",
        "author_handle",
        "platform",
        rounded(F.col("pagerank_score"), 6).alias("pagerank"),
        F.col("in_degree").alias("incoming_citations"),
        "total_posts",
        "negative_posts",
        percent(F.col("negative_posts"), F.col("total_posts"), 1).alias("neg_post_pct"),
        rounded(F.col("amplification_risk_score"), 4).alias("risk_index"),
    )


def dashboard_amplifiers(scores: DataFrame, k: int = 10, latest_only: bool = False) -> DataFrame:
    """Dashboard panel: all snapshots, or the newest with latest_only."""
    chosen = latest(scores, "calculated_at") if latest_only else scores
    return riskiest(chosen, k).select(
        "author_handle",
        "platform",
        rounded(F.col("pagerank_score"), 5).alias("pagerank"),
        "negative_posts",
        rounded(F.col("amplification_risk_score"), 2).alias("risk_index"),
    )


def top_of_run(scores: DataFrame, k: int = 10) -> DataFrame:
    """Head of a run that has just been scored."""
    return riskiest(scores, k).select(
        "author_handle",
        "platform",
        "pagerank_score",
        "negative_posts",
        "total_posts",
        "amplification_risk_score",
    )


def active_topics(clusters: DataFrame) -> DataFrame:
    """Topics of the newest run, largest first, with their first five keywords."""
    return (
        latest(clusters, "run_date")
        .select(
            "run_date",
            "topic_id",
            "topic_label",
            F.array_join(F.slice("top_keywords", 1, 5), ", ").alias("primary_keywords"),
            "post_count",
            rounded(F.col("mean_sentiment"), 3).alias("cluster_sentiment"),
            rounded(F.col("positive_ratio") * 100, 1).alias("pct_pos"),
            rounded(F.col("negative_ratio") * 100, 1).alias("pct_neg"),
        )
        .orderBy(F.desc("post_count"), "topic_id")
    )


def active_alerts(alerts: DataFrame, as_of=None) -> DataFrame:
    """Open alerts of the last 24 hours, counted."""
    return (
        lookback(alerts, "24 hours", as_of, "detected_at")
        .filter(F.col("status").isin("triggered", "investigating"))
        .agg(F.count(F.lit(1)).alias("active_alerts"))
    )


def incident_history(alerts: DataFrame, k: int = 20) -> DataFrame:
    """Newest alerts first."""
    return (
        alerts.orderBy(F.desc("detected_at"), "platform")
        .limit(k)
        .select(
            "alert_id",
            "detected_at",
            "platform",
            rounded(F.col("cusum_statistic"), 3).alias("cusum_val"),
            rounded(F.col("threshold_h"), 3).alias("threshold"),
            rounded(F.col("baseline_sentiment"), 3).alias("baseline"),
            rounded(F.col("observed_sentiment"), 3).alias("observed"),
            "affected_volume",
            "status",
            "incident_summary",
        )
    )
