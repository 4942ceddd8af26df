"""Sketch rollups against exact counts, whatever the parts, and rows without authors or scores."""

import datetime as dt
import random

import pytest

from postlens.operators import sketches
from postlens.plans.catalog import QUERIES
from postlens.plans.oracle import ORACLE
from tests.compare import connect, difference

SCHEMA = "created_at timestamp, platform string, author_id string, sentiment_score double, is_spam boolean"


def posts(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_a_day_from_its_quarters(spark):
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    rows = [
        (start + dt.timedelta(seconds=rng.randrange(86400)), "x", f"a{int(rng.paretovariate(0.5)) % 9000}", rng.gauss(0, 1), False)
        for _ in range(20000)
    ]
    quarters = sketches.sketch_rollup(posts(spark, rows))
    (day,) = sketches.read_out(sketches.merged(quarters, "1day")).collect()
    authors, scores = len({r[2] for r in rows}), sorted(r[3] for r in rows)
    assert (day.posts, day.parts) == (20000, 96)
    assert day.authors == pytest.approx(authors, rel=sketches.AUTHOR_BOUND)
    for name, share in sketches.QUARTILES.items():
        assert sum(s < day[name] for s in scores) / 20000 == pytest.approx(share, abs=sketches.RANK_BOUND)
    # By way of hours the counts are the same; an estimate depends on the order of merges, within the same bound.
    (again,) = sketches.read_out(sketches.merged(sketches.merged(quarters, "1hour").drop("parts"), "1day")).collect()
    assert (again.posts, again.parts) == (day.posts, 24)
    assert again.authors == pytest.approx(authors, rel=sketches.AUTHOR_BOUND)


def test_bounds_are_seen_to_be_broken(spark):
    start = dt.datetime(2024, 1, 1)
    rows = posts(spark, [(start, "x", f"a{i}", i / 100, False) for i in range(100)])
    days = sketches.read_out(sketches.merged(sketches.sketch_rollup(rows), "1day"))
    assert tuple(sketches.accuracy(rows, days, "1day").first())[2:] == (1, 100, 100, True, True)
    wrong = days.selectExpr("window_start", "platform", "parts", "authors + 50 AS authors", "q25", "q50 + 0.3 AS q50", "q75")
    assert tuple(sketches.accuracy(rows, wrong, "1day").first())[-2:] == (False, False)


def test_nulls_spam_and_no_rows(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [(start, "x", None, None, False), (start, "x", "a", None, False), (start, "x", "b", 0.5, True), (None, "x", "c", 1.0, False)]
    (day,) = sketches.read_out(sketches.merged(sketches.sketch_rollup(posts(spark, rows)), "1day")).collect()
    assert (day.authors, day.q50) == (1, None)
    assert sketches.sketch_rollup(posts(spark, [])).collect() == []


def test_query_equals_its_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    name = "sketch_rollup_1day"
    assert difference(spark, connect(sf_dir), sf_dir, QUERIES[name], ORACLE[name]) is None
