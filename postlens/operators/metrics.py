"""Sentiment and volume metrics over silver posts.

Every aggregate here combines on the map side, so a platform that holds most of the rows
costs no more than the others: what is shuffled is one partial row per task and group.
"""

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postlens.functions.numeric import (
    count_label,
    label_counts,
    mean_score,
    net_sentiment,
    percent,
    rounded,
    row_count,
)
from postlens.operators.filters import between_days, lookback, not_spam, on_day
from postlens.schemas import GRANULARITIES, POST_KEY


def realtime_kpis(posts: DataFrame, as_of=None) -> DataFrame:
    return (
        not_spam(lookback(posts, "24 hours", as_of))
        .groupBy("platform")
        .agg(
            row_count().alias("total_posts_24h"),
            *label_counts("negative_posts", "neutral_posts", "positive_posts"),
            mean_score().alias("avg_sentiment_score"),
            net_sentiment().alias("net_sentiment_score_nss"),
        )
    )


def hourly_nss(posts: DataFrame, as_of=None) -> DataFrame:
    return (
        not_spam(lookback(posts, "7 days", as_of))
        .groupBy(F.date_trunc("hour", "created_at").alias("hour_bucket"), "platform")
        .agg(
            row_count().alias("total_posts"),
            *label_counts("neg_count", "neu_count", "pos_count"),
            mean_score().alias("mean_sentiment"),
            net_sentiment().alias("net_sentiment_score"),
        )
        .orderBy(F.desc("hour_bucket"), "platform")
    )


def with_posts(aspects: DataFrame, posts: DataFrame, period=None) -> DataFrame:
    """Aspect rows of the given posts."""
    return same_period(aspects, period).join(posts.select(*POST_KEY), POST_KEY)


def same_period(rows: DataFrame, period) -> DataFrame:
    """Cut a table joined by post key to the period of the posts, so that its old days are not read.

    A post has one created_at in all tables; a table without that column is read whole.
    """
    return period(rows) if period is not None and "created_at" in rows.columns else rows


def aspect_summary(aspects: DataFrame, posts: DataFrame, as_of=None) -> DataFrame:
    period = last("24 hours", as_of)
    return (
        with_posts(aspects, not_spam(period(posts)), period)
        .groupBy("aspect")
        .agg(
            row_count().alias("mention_count"),
            mean_score().alias("avg_score"),
            *[
                percent(count_label(label), row_count(), 1).alias(f"pct_{label}")
                for label in ("positive", "neutral", "negative")
            ],
        )
        .orderBy(F.desc("mention_count"), "aspect")
    )


def aspect_pain_points(aspects: DataFrame, posts: DataFrame, as_of=None) -> DataFrame:
    """Worst aspect first. Spam counts here."""
    period = last("48 hours", as_of)
    return (
        with_posts(aspects, period(posts), period)
        .groupBy("aspect")
        .agg(
            row_count().alias("total_mentions"),
            mean_score().alias("aspect_sentiment_score"),
            percent(count_label("negative"), row_count(), 2).alias("negative_pct"),
            percent(count_label("positive"), row_count(), 2).alias("positive_pct"),
            net_sentiment().alias("aspect_nss"),
        )
        .orderBy("aspect_sentiment_score", "aspect")
    )


def aspect_scores(aspects: DataFrame) -> DataFrame:
    """All-time mean per aspect, worst first."""
    return (
        aspects.groupBy("aspect")
        .agg(mean_score(3).alias("score"))
        .orderBy("score", "aspect")
    )


def with_engagement(posts: DataFrame, raw: DataFrame, period) -> DataFrame:
    """Posts of a period (a filter function) beside the engagement map of their raw copy."""
    engagement = same_period(raw, period).select(*POST_KEY, "engagement")
    return period(posts).join(engagement, POST_KEY)


def last(interval: str, as_of):
    return partial(lookback, interval=interval, as_of=as_of)


def days(first, until=None):
    return partial(between_days, first=first, last=until or first)


def cross_platform(posts: DataFrame, raw: DataFrame, as_of=None, approximate=False) -> DataFrame:
    """Authors, volume, mood and engagement per platform. Spam counts here."""
    authors = F.approx_count_distinct if approximate else F.count_distinct
    return (
        with_engagement(posts, raw, last("24 hours", as_of))
        .groupBy("platform")
        .agg(
            authors("author_id").alias("unique_active_users"),
            row_count().alias("total_posts"),
            mean_score().alias("avg_sentiment"),
            net_sentiment().alias("nss"),
            *[
                rounded(F.avg(F.col("engagement")[kind]), 1).alias(f"avg_{kind}")
                for kind in ("likes", "reposts", "replies")
            ],
        )
    )


def rollup(posts: DataFrame, granularity: str) -> DataFrame:
    """Gold time series for one granularity: 15min, 1hour or 1day."""
    spam_free = not_spam(posts)
    return (
        spam_free.groupBy(F.window("created_at", GRANULARITIES[granularity]).alias("w"), "platform")
        .agg(
            row_count().alias("total_volume"),
            *label_counts("negative_count", "neutral_count", "positive_count"),
            mean_score().alias("mean_sentiment"),
            rounded(F.coalesce(F.stddev_samp("sentiment_score"), F.lit(0.0)), 4).alias(
                "sentiment_std_dev"
            ),
            net_sentiment().alias("net_sentiment_score"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            F.lit(granularity).alias("granularity"),
            "platform",
            "total_volume",
            "positive_count",
            "neutral_count",
            "negative_count",
            "mean_sentiment",
            "sentiment_std_dev",
            "net_sentiment_score",
        )
    )


def daily_rollup(posts: DataFrame, day) -> DataFrame:
    return rollup(on_day(posts, day), "1day")


def window_stats(posts: DataFrame, width: str = "15 minutes") -> DataFrame:
    """Clean posts per tumbling window and platform: the input of every change-point job."""
    return (
        not_spam(posts)
        .groupBy(F.window("created_at", width).alias("w"), "platform")
        .agg(
            row_count().alias("post_count"),
            F.avg("sentiment_score").alias("avg_sentiment"),
            F.stddev_samp("sentiment_score").alias("stddev_sentiment"),
        )
        .select(
            "platform",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "post_count",
            "avg_sentiment",
            "stddev_sentiment",
        )
    )


def window_stats_15min(posts: DataFrame, as_of=None) -> DataFrame:
    return window_stats(lookback(posts, "24 hours", as_of)).select(
        F.col("window_start").alias("interval_15min"),
        "platform",
        "post_count",
        "avg_sentiment",
        "stddev_sentiment",
    )


def rolling_baseline(posts: DataFrame, as_of=None) -> DataFrame:
    """Mean of the last nine window means per platform; missing windows are not counted.

    The window function sees one row per 15 minutes and platform, never posts.
    """
    last_nine = W.partitionBy("platform").orderBy("interval_15min").rowsBetween(-8, 0)
    return (
        window_stats_15min(posts, as_of)
        .select(
            "interval_15min",
            "platform",
            "post_count",
            rounded(F.col("avg_sentiment"), 4).alias("current_mean"),
            rounded(F.coalesce("stddev_sentiment", F.lit(0.0)), 4).alias("current_stddev"),
            rounded(F.avg("avg_sentiment").over(last_nine), 4).alias("rolling_2hr_baseline"),
        )
        .orderBy(F.desc("interval_15min"), "platform")
    )


def recent_window(
    posts: DataFrame, as_of=None, minutes: int = 15, min_posts: int = 10, platform=None
) -> DataFrame:
    """One row for the window that ends now; none when it holds too few posts."""
    recent = not_spam(lookback(posts, f"{minutes} minutes", as_of))
    if platform is not None:
        recent = recent.filter(F.col("platform") == platform)
    return (
        recent.agg(
            row_count().alias("post_count"),
            F.coalesce(F.avg("sentiment_score"), F.lit(0.0)).alias("mean_sentiment"),
            F.coalesce(F.stddev_samp("sentiment_score"), F.lit(0.0)).alias("std_sentiment"),
            F.min("created_at").alias("window_start"),
            F.max("created_at").alias("window_end"),
        )
        .filter(F.col("post_count") >= min_posts)
        .withColumn("platform", F.lit(platform or "all_platforms"))
    )


def ingestion_health(posts: DataFrame, as_of=None, low_confidence: float = 0.60) -> DataFrame:
    spam = F.count_if("is_spam")
    return (
        lookback(posts, "7 days", as_of)
        .groupBy(F.date_trunc("day", "created_at").alias("date_day"), "platform")
        .agg(
            row_count().alias("total_evaluated"),
            spam.alias("spam_rejected"),
            percent(spam, row_count(), 2).alias("spam_rejection_pct"),
            F.count_if(F.col("confidence") < low_confidence).alias("low_confidence_count"),
        )
        .orderBy(F.desc("date_day"), "platform")
    )


def nss_24h(posts: DataFrame, as_of=None) -> DataFrame:
    recent = not_spam(lookback(posts, "24 hours", as_of))
    return recent.agg(net_sentiment(1).alias("net_sentiment_score"))


def post_count(posts: DataFrame, as_of=None, keep_spam: bool = False) -> DataFrame:
    recent = lookback(posts, "24 hours", as_of)
    return (recent if keep_spam else not_spam(recent)).agg(row_count().alias("total_posts"))


def spam_rate(posts: DataFrame, as_of=None, digits: int = 1) -> DataFrame:
    """Share of spam in the last 24 hours."""
    return spam_share(lookback(posts, "24 hours", as_of), digits)


def spam_share(posts: DataFrame, digits: int = 2) -> DataFrame:
    """Share of spam in all rows given."""
    return posts.agg(percent(F.count_if("is_spam"), row_count(), digits).alias("spam_rejection_pct"))


def hourly_mean_vs_baseline(posts: DataFrame, as_of=None, baseline: float = 0.35) -> DataFrame:
    """Hourly mean without spam beside a constant; an hour of spam only keeps the constant."""
    clean = F.when(~F.col("is_spam"), F.col("sentiment_score"))
    return (
        lookback(posts, "48 hours", as_of)
        .groupBy(F.date_trunc("hour", "created_at").alias("time"))
        .agg(
            rounded(F.avg(clean), 6).alias("mean_sentiment"),
            F.lit(baseline).alias("in_control_baseline"),
        )
        .orderBy("time")
    )


def polarity_share(posts: DataFrame, as_of=None) -> DataFrame:
    recent = not_spam(lookback(posts, "24 hours", as_of))
    return recent.groupBy("sentiment_label").agg(row_count().alias("volume"))


def author_sentiment(posts: DataFrame, lookback_days: int = 7, as_of=None) -> DataFrame:
    return (
        not_spam(lookback(posts, f"{lookback_days} days", as_of))
        .groupBy("author_id", "author_handle", "platform")
        .agg(
            row_count().alias("total_posts"),
            count_label("negative").alias("negative_posts"),
            count_label("positive").alias("positive_posts"),
            F.avg("sentiment_score").alias("mean_sentiment"),
        )
    )


def daily_totals(posts: DataFrame, first, until=None) -> DataFrame:
    """Label totals of one day, or of the days first..until for a weekly report."""
    return not_spam(days(first, until)(posts)).agg(
        row_count().alias("total_volume"),
        *label_counts("negative_volume", "neutral_volume", "positive_volume"),
        F.coalesce(net_sentiment(1), F.lit(0.0)).alias("nss"),
    )


def interactions(engagement: Column) -> Column:
    """likes + reposts + replies; a missing kind counts 0."""
    total = F.lit(0).cast("bigint")
    for kind in ("likes", "reposts", "replies"):
        total = total + F.coalesce(engagement[kind], F.lit(0))
    return total


def platform_report(posts: DataFrame, raw: DataFrame, first, until=None) -> DataFrame:
    """Volume, share, mood and interactions per post of each platform in the report period."""
    counted = (
        with_engagement(not_spam(posts), raw, days(first, until))
        .groupBy("platform")
        .agg(
            row_count().alias("volume"),
            net_sentiment(1).alias("nss"),
            mean_score(2).alias("avg_score"),
            rounded(F.avg(interactions(F.col("engagement"))), 1).alias("avg_engagement"),
        )
    )
    # One row per platform reaches this window.
    return counted.withColumn(
        "share_pct", percent(F.col("volume"), F.sum("volume").over(W.partitionBy()), 1)
    )


def platform_dynamics(posts: DataFrame, raw: DataFrame, hours: int = 24, as_of=None) -> DataFrame:
    """Score variance and interactions per hour of each platform."""
    return (
        with_engagement(not_spam(posts), raw, last(f"{hours} hours", as_of))
        .groupBy("platform")
        .agg(
            rounded(F.var_samp("sentiment_score"), 4).alias("sentiment_variance"),
            rounded(F.sum(interactions(F.col("engagement"))) / hours, 2).alias(
                "engagement_velocity"
            ),
        )
    )


def readiness(posts: DataFrame, as_of=None, min_posts: int = 1) -> DataFrame:
    """The daily job's first check: how many posts arrived, and whether that is enough."""
    return post_count(posts, as_of, keep_spam=True).withColumn(
        "ready", F.col("total_posts") >= min_posts
    )
