"""The daily (or weekly) report as one nested row built from the small gold results."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.numeric import count_label, mean_score, percent, row_count
from postlens.operators.filters import HIGH_RISK, between_days, not_spam, sentiment_band
from postlens.operators.metrics import (
    daily_totals,
    days,
    platform_report,
    with_posts,
)
from postlens.operators.rankings import latest, riskiest


def aspect_section(aspects: DataFrame, posts: DataFrame, first, last=None) -> DataFrame:
    """Score, shares and mentions per aspect in the report period, with a band for each."""
    period = days(first, last)
    return (
        with_posts(aspects, not_spam(period(posts)), period)
        .groupBy("aspect")
        .agg(
            mean_score(2).alias("score"),
            *[
                percent(count_label(label), row_count(), 1).alias(f"{label}_pct")
                for label in ("positive", "neutral", "negative")
            ],
            row_count().alias("mention_count"),
        )
        .withColumn("band", sentiment_band(F.col("score"), "aspect"))
    )


def platform_section(posts: DataFrame, raw: DataFrame, first, last=None) -> DataFrame:
    return platform_report(posts, raw, first, last).withColumn(
        "band", sentiment_band(F.col("nss"), "platform_nss")
    )


def topic_section(clusters: DataFrame, k: int = 10) -> DataFrame:
    """Largest topics of the newest run."""
    return (
        latest(clusters, "run_date")
        .orderBy(F.desc("post_count"), "topic_id")
        .limit(k)
        .select(
            "topic_id",
            "topic_label",
            "top_keywords",
            "post_count",
            "mean_sentiment",
            F.get("representative_samples", F.lit(0)).alias("sample_doc"),
            sentiment_band(F.col("mean_sentiment"), "topic").alias("band"),
        )
    )


def alert_section(alerts: DataFrame, first, last=None) -> DataFrame:
    """All alerts of the period, newest first."""
    return (
        between_days(alerts, first, last or first, "detected_at")
        .orderBy(F.desc("detected_at"), "platform")
        .select(
            "alert_id",
            "detected_at",
            "platform",
            F.col("cusum_statistic").alias("cusum_stat"),
            "observed_sentiment",
            "affected_volume",
            F.col("incident_summary").alias("summary"),
        )
    )


def amplifier_section(scores: DataFrame, k: int = 10) -> DataFrame:
    return riskiest(latest(scores, "calculated_at"), k).select(
        "author_handle",
        "platform",
        "pagerank_score",
        "negative_posts",
        "total_posts",
        "amplification_risk_score",
    )


def incident_count(alerts: DataFrame, first, last=None) -> DataFrame:
    return between_days(alerts, first, last or first, "detected_at").agg(
        row_count().alias("crisis_count")
    )


def amplifier_count(scores: DataFrame, limit: float = HIGH_RISK) -> DataFrame:
    """Authors at or above the risk limit in the newest snapshot."""
    return latest(scores, "calculated_at").agg(
        F.count_if(F.col("amplification_risk_score") >= limit).alias("amplifier_count")
    )


def as_list(section: DataFrame, name: str, *order) -> DataFrame:
    """A bounded section (platforms, aspects or a top-k) as one array of structs.

    Each order column, with a minus sign for descending numbers, sorts the array.
    """
    keys = [
        (-F.col(o[1:])).alias(f"_k{i}") if o.startswith("-") else F.col(o).alias(f"_k{i}")
        for i, o in enumerate(order)
    ]
    row = F.struct(*section.columns)
    return section.agg(
        F.array_sort(F.collect_list(F.struct(*keys, row.alias("row")))).getField("row").alias(name)
    )


def daily_report(
    posts: DataFrame,
    raw: DataFrame,
    aspects: DataFrame,
    alerts: DataFrame,
    scores: DataFrame,
    clusters: DataFrame,
    first,
    last=None,
    brand: str = "brand",
) -> DataFrame:
    """One row with all sections; last makes it a report over several days."""
    totals = daily_totals(posts, first, last)
    kpis = totals.select(
        F.struct(
            "nss",
            sentiment_band(F.col("nss"), "kpi_nss").alias("band"),
            "total_volume",
            "positive_volume",
            "negative_volume",
            "neutral_volume",
            incident_count(alerts, first, last).scalar().alias("crisis_count"),
            amplifier_count(scores).scalar().alias("amplifier_count"),
        ).alias("kpis")
    )
    sections = [
        as_list(aspect_section(aspects, posts, first, last), "aspect_metrics", "-score", "aspect"),
        as_list(platform_section(posts, raw, first, last), "platform_metrics", "platform"),
        as_list(topic_section(clusters), "trending_topics", "-post_count", "topic_id"),
        as_list(alert_section(alerts, first, last), "crisis_alerts", "detected_at", "platform"),
        as_list(amplifier_section(scores), "top_amplifiers", "-amplification_risk_score"),
    ]
    return kpis.select(
        F.lit(brand).alias("brand_name"),
        F.lit(str(first)).cast("date").alias("report_date"),
        F.lit(str(last or first)).cast("date").alias("report_end"),
        "kpis",
        *[section.scalar().alias(section.columns[0]) for section in sections],
    )
