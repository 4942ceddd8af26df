"""Rounding, shares and label counts used by all metric queries."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.schemas import LABELS


def rounded(value: Column, digits: int) -> Column:
    """Half-up rounding that agrees with exact decimal arithmetic.

    The inner round drops binary noise, so 12.344999999999999 counts as the tie 12.345.
    """
    return F.round(F.round(value, 10), digits)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """part / whole as a percentage; NULL when whole is 0."""
    return rounded(100 * part / F.nullif(whole, F.lit(0)), digits)


def row_count() -> Column:
    return F.count(F.lit(1))


def count_label(label: str) -> Column:
    return F.count_if(F.col("sentiment_label") == label)


def label_counts(negative: str, neutral: str, positive: str) -> list[Column]:
    names = dict(zip(LABELS, (negative, neutral, positive)))
    return [count_label(label).alias(names[label]) for label in reversed(LABELS)]


def net_sentiment(digits: int = 2) -> Column:
    """Aggregate: (positive - negative) / all * 100."""
    return percent(count_label("positive") - count_label("negative"), row_count(), digits)


def mean_score(digits: int = 4) -> Column:
    return rounded(F.avg("sentiment_score"), digits)
