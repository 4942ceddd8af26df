"""CUSUM change-point detection over window means.

Input everywhere: platform, window_start, window_end, post_count, avg_sentiment, as made by
metrics.window_stats. These rows are aggregates, at most one per window and platform (35,000 a year
for 15-minute windows), so ordering one platform's windows in one task stays cheap whatever the
number of posts.
"""

from dataclasses import dataclass
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postlens.functions.numeric import rounded

ALL_PLATFORMS = "all_platforms"


@dataclass(frozen=True)
class ChartSettings:
    """Slack and threshold are given in units of sigma."""

    baseline: float = 0.35
    sigma: float = 0.20
    slack: float = 0.5
    threshold: float = 4.5
    min_posts: int = 10
    cooldown_minutes: int = 60
    kept_after_alert: float = 0.7

    @property
    def k(self) -> float:
        return self.slack * self.sigma

    @property
    def h(self) -> float:
        return self.threshold * self.sigma


def in_time(*columns):
    return W.partitionBy("platform").orderBy(*(columns or ["window_start"]))


def enough_posts(windows: DataFrame, settings: ChartSettings) -> DataFrame:
    return windows.filter(F.col("post_count") >= settings.min_posts)


def reflected_sum(step: str, key: str, order: str):
    """S_t = max(0, S_{t-1} + step) without a loop: the running sum above its running minimum.

    Returns a function that adds column `cusum` to a DataFrame.
    """
    w = W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)

    def add(df: DataFrame) -> DataFrame:
        summed = df.withColumn("_c", F.sum(step).over(w))
        lowest = F.least(F.lit(0.0), F.min("_c").over(w))
        return summed.withColumn("cusum", F.col("_c") - lowest).drop("_c")

    return add


def cusum(
    windows: DataFrame, settings: ChartSettings = ChartSettings(), upper: bool = False
) -> DataFrame:
    """The statistic per window without reset, and whether it is above the threshold.

    The lower chart grows when the mean falls below baseline - k, the upper one when it rises
    above baseline + k.
    """
    away = F.col("avg_sentiment") - settings.baseline
    step = (away if upper else -away) - settings.k
    charted = reflected_sum("_step", "platform", "window_start")(
        enough_posts(windows, settings).withColumn("_step", step)
    )
    return charted.withColumn("alarm", F.col("cusum") > settings.h + 1e-12).drop("_step")


def first_alarm(charted: DataFrame, onset=None, width_minutes: int = 15) -> DataFrame:
    """First alarmed window per platform; with a known onset, the delay in windows and minutes."""
    first = charted.groupBy("platform").agg(
        F.min(F.when(F.col("alarm"), F.col("window_start"))).alias("first_alarm")
    )
    if onset is None:
        return first
    since = charted.filter(F.col("alarm")).filter(
        F.col("window_start") >= F.lit(onset).cast("timestamp")
    )
    delay = F.timestamp_diff("MINUTE", F.lit(onset).cast("timestamp"), F.col("first_after_onset"))
    return first.join(
        since.groupBy("platform").agg(F.min("window_start").alias("first_after_onset")),
        "platform",
        "left",
    ).select(
        "platform",
        "first_alarm",
        "first_after_onset",
        delay.alias("delay_minutes"),
        F.floor(delay / width_minutes).alias("delay_windows"),
    )


def advance(statistic, last_alert, mean, now, settings: ChartSettings):
    """One window of the resetting chart: (statistic, last_alert, statistic at alert or None).

    An alarm inside the cooldown raises nothing and keeps the statistic. `now` is event time.
    """
    statistic = max(0.0, statistic + settings.baseline - mean - settings.k)
    if statistic <= settings.h:
        return statistic, last_alert, None
    if last_alert is not None and now - last_alert < timedelta(minutes=settings.cooldown_minutes):
        return statistic, last_alert, None
    return settings.kept_after_alert * settings.h, now, statistic


ALERT_COLUMNS = (
    "platform string, window_start timestamp, window_end timestamp, cusum_statistic double, "
    "observed_sentiment double, affected_volume bigint"
)
ALERT_NAMES = [part.split()[0] for part in ALERT_COLUMNS.split(", ")]


def scan_windows(rows: pd.DataFrame, statistic, last_alert, settings: ChartSettings):
    """Run `advance` over windows in time order: (alert rows, statistic, last_alert)."""
    found = []
    for row in rows.sort_values("window_start").itertuples(index=False):
        statistic, last_alert, reached = advance(
            statistic, last_alert, row.avg_sentiment, row.window_end, settings
        )
        if reached is not None:
            found.append(
                (
                    row.platform,
                    row.window_start,
                    row.window_end,
                    reached,
                    row.avg_sentiment,
                    row.post_count,
                )
            )
    return found, statistic, last_alert


def raw_alerts(windows: DataFrame, settings: ChartSettings = ChartSettings()) -> DataFrame:
    """Alerts of the resetting chart, one task per platform over its windows."""

    def scan(rows: pd.DataFrame) -> pd.DataFrame:
        found, _, _ = scan_windows(rows, 0.0, None, settings)
        return pd.DataFrame(found, columns=ALERT_NAMES)

    return (
        enough_posts(windows, settings)
        .select("platform", "window_start", "window_end", "post_count", "avg_sentiment")
        .groupBy("platform")
        .applyInPandas(scan, ALERT_COLUMNS)
    )


def with_payload(alerts: DataFrame, settings: ChartSettings = ChartSettings()) -> DataFrame:
    """Alert table rows: rounded measures, a summary sentence and the whole payload as JSON.

    The id comes from platform and window, so a replay writes the same alert again.
    """
    observed = F.col("observed_sentiment")
    summary = F.format_string(
        "Significant sentiment crash detected on %s. Rolling sentiment plunged to %.3f "
        "across %d posts.",
        F.col("platform"),
        rounded(observed, 3),
        F.col("affected_volume"),
    )
    table = alerts.select(
        F.left(
            F.sha2(
                F.concat_ws("|", "platform", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss")),
                256,
            ),
            F.lit(32),
        ).alias("alert_id"),
        F.col("window_end").alias("detected_at"),
        "platform",
        "window_start",
        "window_end",
        rounded(F.col("cusum_statistic"), 4).alias("cusum_statistic"),
        F.lit(round(settings.h, 4)).alias("threshold_h"),
        F.lit(round(settings.baseline, 4)).alias("baseline_sentiment"),
        rounded(observed, 4).alias("observed_sentiment"),
        rounded(settings.baseline - observed, 4).alias("deviation_magnitude"),
        "affected_volume",
        F.lit("triggered").alias("status"),
        summary.alias("incident_summary"),
    )
    payload = [c for c in table.columns if c not in ("alert_id", "status")]
    return table.withColumn("alert_payload", F.to_json(F.struct(*payload)))


def crisis_alerts(windows: DataFrame, settings: ChartSettings = ChartSettings()) -> DataFrame:
    return with_payload(raw_alerts(windows, settings), settings)


def for_all_platforms(posts: DataFrame) -> DataFrame:
    """Posts once under their platform and once under `all_platforms`."""
    both = F.array(F.col("platform"), F.lit(ALL_PLATFORMS))
    return posts.withColumn("platform", F.explode(both))
