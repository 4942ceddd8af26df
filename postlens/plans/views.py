"""The standing reports as named views for SQL users."""

from pyspark.sql import DataFrame, SparkSession

from postlens.operators import metrics, rankings


def register_views(spark: SparkSession, posts: DataFrame, aspects: DataFrame, scores: DataFrame, as_of=None) -> list[str]:
    """Temporary views over the scored posts, the aspect rows and the influence scores; their names."""
    views = {
        "v_realtime_sentiment_kpis": metrics.realtime_kpis(posts, as_of),
        "v_aspect_summary": metrics.aspect_summary(aspects, posts, as_of),
        "v_top_negative_amplifiers": rankings.recent_amplifiers(scores, as_of),
    }
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)
    return list(views)
