"""Row filters. Each keeps the bare column on one side so that it reaches the file scan."""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def moment(as_of=None) -> Column:
    """as_of as a timestamp column; the query's NOW() when none is given."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (datetime, date)):
        as_of = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of.isoformat()
    return F.lit(as_of).cast("timestamp")


def lookback(df: DataFrame, interval: str, as_of=None, column: str = "created_at") -> DataFrame:
    """Rows no older than interval before as_of. There is no upper bound."""
    return df.filter(F.col(column) >= moment(as_of) - F.expr(f"interval {interval}"))


def on_day(df: DataFrame, day, column: str = "created_at") -> DataFrame:
    """Rows of one calendar day, as a half-open range."""
    start = F.lit(str(day)).cast("date").cast("timestamp")
    return df.filter((F.col(column) >= start) & (F.col(column) < start + F.expr("interval 1 day")))


def between_days(df: DataFrame, first, last, column: str = "created_at") -> DataFrame:
    """Rows from the start of first to the end of last."""
    start = F.lit(str(first)).cast("date").cast("timestamp")
    stop = F.lit(str(last)).cast("date").cast("timestamp") + F.expr("interval 1 day")
    return df.filter((F.col(column) >= start) & (F.col(column) < stop))


def not_spam(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_spam"))


def has_keyword(text: Column, keywords: list[str]) -> Column:
    """True when text holds any keyword, whatever the case; never true for empty text."""
    lowered = F.lower(text)
    hit = F.lit(False)
    for word in keywords:
        hit = hit | F.contains(lowered, F.lit(word.lower()))
    return F.coalesce((text != "") & hit, F.lit(False))


def keyword_filter(df: DataFrame, keywords: list[str], column: str = "text") -> DataFrame:
    return df.filter(has_keyword(F.col(column), keywords))


def topic_corpus(posts: DataFrame, day=None, min_chars: int = 15) -> DataFrame:
    """Texts worth clustering: one day (or all), no spam, longer than min_chars."""
    chosen = posts if day is None else on_day(posts, day)
    return not_spam(chosen).filter(F.char_length("clean_text") > min_chars)


def band(value: Column, low: float, high: float) -> Column:
    """negative below low, positive above high, neutral between."""
    return (
        F.when(value > high, "positive")
        .when(value < low, "negative")
        .when(value.isNotNull(), "neutral")
    )


# Band limits by report section.
BANDS = {
    "aspect": (-0.15, 0.15),
    "platform_nss": (0.0, 10.0),
    "topic": (-0.1, 0.1),
    "kpi_nss": (0.0, 20.0),
    "chart": (-0.1, 0.1),
}
GAUGE_STEPS = (0.0, 30.0)
HIGH_RISK = 50.0


def sentiment_band(value: Column, section: str) -> Column:
    return band(value, *BANDS[section])


def gauge_step(value: Column) -> Column:
    """0 below the first step, 1 from it, 2 from the second."""
    low, high = GAUGE_STEPS
    return F.when(value >= high, 2).when(value >= low, 1).when(value.isNotNull(), 0)
