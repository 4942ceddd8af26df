"""Every query against its SQL on the smallest tables."""

import pytest

from postlens.plans.catalog import QUERIES
from postlens.plans.oracle import ORACLE
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
NO_SQL = {"network_clusters", "nmf_topics", "embedding_topics", "score_documents", "evaluate_heads"}


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_every_query_has_sql_or_is_listed():
    assert set(QUERIES) - set(ORACLE) == NO_SQL
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, tables, name):
    assert difference(spark, tables, SF_DIR, QUERIES[name], ORACLE[name]) is None


def test_flagship_query(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns[0] == "hour_bucket"


@pytest.mark.parametrize("name", ["aspect_summary", "aspect_pain_points", "aspect_report"])
def test_time_filter_reaches_both_scans(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert len(scans) >= 2
    assert all("GreaterThanOrEqual(ts" in line for line in scans)
