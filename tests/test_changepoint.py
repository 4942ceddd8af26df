"""CUSUM forms against the step-by-step loop."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings as hyp
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlens.operators import changepoint as cp

START = dt.datetime(2024, 1, 1)
CHART = cp.ChartSettings()


def frame(spark, series, platform="p", posts=20):
    rows = [
        (platform, START + dt.timedelta(minutes=15 * i), START + dt.timedelta(minutes=15 * (i + 1)), n, x)
        for i, (x, n) in enumerate(x if isinstance(x, tuple) else (x, posts) for x in series)
    ]
    return spark.createDataFrame(
        rows,
        "platform string, window_start timestamp, window_end timestamp, post_count bigint, avg_sentiment double",
    )


def loop(series, upper=False):
    s, out = 0.0, []
    for x in series:
        away = x - CHART.baseline
        s = max(0.0, s + (away if upper else -away) - CHART.k)
        out.append(s)
    return out


def outage(seed=1):
    rng = random.Random(seed)
    means = [0.35] * 20 + [-0.25] * 10 + [0.28] * 15
    return [rng.gauss(m, 0.2) for m in means]


@pytest.mark.parametrize("upper", [False, True])
def test_closed_form_equals_loop(spark, upper):
    series = outage()
    found = cp.cusum(frame(spark, series), upper=upper).orderBy("window_start").collect()
    for row, s in zip(found, loop(series, upper)):
        assert row.cusum == pytest.approx(s, abs=1e-9)
        assert row.alarm == (s > CHART.h)


def test_constant_baseline_never_alarms(spark):
    assert cp.cusum(frame(spark, [0.35] * 200)).filter("alarm").count() == 0


def test_drop_is_found_within_windows(spark):
    charted = cp.cusum(frame(spark, [0.35] * 20 + [-0.25] * 10))
    onset = START + dt.timedelta(minutes=15 * 20)
    row = cp.first_alarm(charted, str(onset)).first()
    # 0.5 per window passes 0.9 in the second window of the drop
    assert row.delay_windows == 1 and row.delay_minutes == 15


def test_statistic_equal_to_threshold_is_no_alarm(spark):
    exact = cp.ChartSettings(baseline=0.5, sigma=0.5, slack=0.5, threshold=1.0)
    charted = cp.cusum(frame(spark, [-0.25]), exact).first()
    assert charted.cusum == exact.h and not charted.alarm
    assert cp.advance(0.0, None, -0.25, START, exact)[2] is None


def test_thin_windows_are_skipped(spark):
    series = [(-1.0, 9), (-1.0, 10), (-1.0, 50)]
    assert cp.cusum(frame(spark, series)).count() == 2
    alerts = cp.crisis_alerts(frame(spark, series)).collect()
    assert [a.affected_volume for a in alerts] == [10]


def test_reset_and_cooldown(spark):
    alerts = cp.raw_alerts(frame(spark, [-1.0] * 10)).orderBy("window_start").collect()
    step = 0.35 + 1.0 - 0.1
    # windows 0..9 end 15 minutes apart; 60 minutes after an alert the next may follow
    assert [a.window_start.minute + 60 * a.window_start.hour for a in alerts] == [0, 60, 120]
    assert alerts[0].cusum_statistic == pytest.approx(step)
    assert alerts[1].cusum_statistic == pytest.approx(0.7 * CHART.h + 4 * step)


def test_suppressed_alarm_keeps_the_statistic():
    s, last, hit = cp.advance(0.0, None, -1.0, START, CHART)
    assert hit == pytest.approx(1.25) and s == pytest.approx(0.63)
    s, last2, hit = cp.advance(s, last, -1.0, START + dt.timedelta(minutes=15), CHART)
    assert hit is None and last2 == last and s == pytest.approx(1.88)


@hyp(max_examples=50, deadline=None)
@given(st.lists(st.floats(-1, 1), min_size=1, max_size=60))
def test_running_minimum_identity(series):
    """The rule behind the closed form."""
    c, low = 0.0, 0.0
    for s, x in zip(loop(series), series):
        c += CHART.baseline - x - CHART.k
        low = min(low, c)
        assert s == pytest.approx(c - low, abs=1e-9)


def test_alert_row(spark):
    row = cp.crisis_alerts(frame(spark, [-1.0], "reddit")).first()
    again = cp.crisis_alerts(frame(spark, [-1.0], "reddit")).first()
    assert row.alert_id == again.alert_id and row.status == "triggered"
    assert row.detected_at == row.window_end
    assert row.deviation_magnitude == 1.35 and row.threshold_h == 0.9
    assert row.incident_summary == (
        "Significant sentiment crash detected on reddit. Rolling sentiment plunged to -1.000 "
        "across 20 posts."
    )
    assert '"cusum_statistic":1.25' in row.alert_payload


def test_all_platforms_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "platform string, x int")
    assert cp.for_all_platforms(df).groupBy("platform").count().filter(
        F.col("platform") == "all_platforms"
    ).first()["count"] == 2
