"""Graph jobs against plain Python on small random graphs, with and without hot-key splitting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from postlens.operators import graph
from postlens.operators.skew import find_hot_keys, salted_join


@pytest.fixture(scope="module")
def small(spark):
    rng = random.Random(7)
    names = [f"n{i:02d}" for i in range(30)]
    pairs = {(a, b) for a in names[:25] for b in rng.sample(names, 3) if a != b}
    pairs |= {("n00", b) for b in names[1:]}  # a hub
    edges = [(a, b, float(rng.randint(1, 9))) for a, b in sorted(pairs)]
    nodes = spark.createDataFrame([(n,) for n in names + ["alone"]], "author_id string")
    return nodes, spark.createDataFrame(edges, "src string, dst string, weight double"), edges


def power_iteration(names, edges, rounds, damping=0.85):
    out = {n: sum(w for a, _, w in edges if a == n) for n in names}
    rank = {n: 1 / len(names) for n in names}
    for _ in range(rounds):
        lost = sum(rank[n] for n in names if not out[n])
        after = {n: (1 - damping) / len(names) + damping * lost / len(names) for n in names}
        for a, b, w in edges:
            after[b] += damping * rank[a] * w / out[a]
        rank = after
    return rank


@pytest.mark.parametrize("min_hot_rows", [1, 10**6])
def test_pagerank_equals_plain_iteration(small, min_hot_rows):
    nodes, edges, rows = small
    ranked = graph.pagerank(nodes, edges, max_iter=6, tol=0.0, min_hot_rows=min_hot_rows).collect()
    names = [r.author_id for r in nodes.collect()]
    expected = power_iteration(names, rows, 6)
    assert {r.author_id for r in ranked} == set(names)
    for row in ranked:
        assert math.isclose(row["rank"], expected[row.author_id], rel_tol=1e-9)
    assert math.isclose(sum(r["rank"] for r in ranked), 1.0, rel_tol=1e-9)


def test_pagerank_stops_when_converged(small):
    nodes, edges, _ = small
    row = graph.pagerank(nodes, edges, tol=1e-5).first()
    assert row.converged and row.iterations < 100


def test_pagerank_of_nothing(spark):
    nodes = spark.createDataFrame([], "author_id string")
    edges = spark.createDataFrame([], "src string, dst string, weight double")
    assert graph.pagerank(nodes, edges).count() == 0


def test_adaptive_planning_is_back_on(spark, small):
    graph.pagerank(small[0], small[1], max_iter=1)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


@pytest.mark.parametrize("min_hot_rows", [1, 10**6])
def test_communities_equal_plain_propagation(small, min_hot_rows):
    nodes, edges, rows = small
    found = graph.communities(nodes, edges, min_hot_rows=min_hot_rows).collect()
    links = {(a, b) for a, b, _ in rows} | {(b, a) for a, b, _ in rows}
    label = {r.author_id: r.author_id for r in nodes.collect()}
    history = []
    while len(history) < 2 or label not in history[-2:]:
        history.append(label)
        after = {}
        for n in label:
            votes = {label[n]: 1}
            for a, b in links:
                if b == n:
                    votes[label[a]] = votes.get(label[a], 0) + 1
            after[n] = min(votes, key=lambda x: (-votes[x], x))
        label = after
    assert {r.author_id: r.community_id for r in found} == label
    assert {(r.converged, r.iterations) for r in found} == {(label == history[-1], len(history))}


def test_labels_that_swap_for_ever_end_unconverged(spark):
    """Every a answers every b: the sides trade labels each round."""
    edges = spark.createDataFrame(
        [(f"a{i}", f"b{k}", 1.0) for i in range(4) for k in range(4)], "src string, dst string, weight double"
    )
    nodes = spark.createDataFrame([(f"{s}{i}",) for s in "ab" for i in range(4)], "author_id string")
    row = graph.communities(nodes, edges).first()
    assert row.iterations < 10


def test_two_groups_are_two_communities(spark):
    edges = spark.createDataFrame(
        [("a", "b", 1.0), ("b", "c", 1.0), ("a", "c", 1.0), ("x", "y", 1.0), ("y", "z", 1.0)],
        "src string, dst string, weight double",
    )
    nodes = spark.createDataFrame([(n,) for n in "abcxyz"], "author_id string")
    members = graph.communities(nodes, edges)
    assert members.select("community_id").distinct().count() == 2
    assert graph.modularity(edges, members).first()[0] > 0.3


def post(i, author, reply=None, handle=None, day=1):
    return (str(i), "reddit", author, handle or f"u/{author}", f"2024-01-{day:02d} 00:00:00", reply)


POSTS = "post_id string, platform string, author_id string, author_handle string, t string, reply_to_id string"


@pytest.mark.parametrize("min_hot_rows", [0, 10**6])
def test_reply_edges(spark, min_hot_rows):
    rows = [
        post(1, "a"),
        post(2, "b", "1", day=9),
        post(3, "b", "1", day=9),
        post(4, "a", "1", day=9),  # self reply
        post(5, "c", "99", day=9),  # parent unknown
        post(6, "c", "1", day=1),  # before the look-back period
        post(7, "reddit_u_[deleted]", "1", day=9),
        post(8, "b", "1", handle="u/other", day=9),
    ]
    raw = spark.createDataFrame(rows, POSTS).withColumn("created_at", F.col("t").cast("timestamp"))
    args = dict(lookback_days=7, as_of="2024-01-10 00:00:00", min_hot_rows=min_hot_rows)
    found = {tuple(r) for r in graph.reply_edges(raw, **args).collect()}
    assert found == {("b", "u/b", "a", "u/a", 2), ("b", "u/other", "a", "u/a", 1)}
    kept = graph.reply_edges(raw, keep_deleted=True, **args)
    assert kept.count() == 3
    # weights of both handles are added
    assert [tuple(r) for r in graph.weighted_edges(graph.reply_edges(raw, **args)).collect()] == [
        ("b", "a", 3.0)
    ]


def test_nodes_and_scores(spark):
    stats = spark.createDataFrame(
        [("a", "h1", "reddit", 3, 1), ("a", "h2", "bluesky", 5, 2), ("lone", "l", "reddit", 4, 4)],
        "author_id string, author_handle string, platform string, total_posts bigint, negative_posts bigint",
    )
    edges = spark.createDataFrame(
        [("a", "h1", "ghost", "g", 2)],
        "source_user string, source_handle string, target_user string, target_handle string, interaction_count bigint",
    )
    nodes = graph.build_nodes(stats, edges)
    found = {r.author_id: tuple(r)[1:] for r in nodes.collect()}
    assert found == {
        "a": ("h2", "bluesky", 8, 3),
        "ghost": ("g", "bluesky", 1, 0),
        "lone": ("l", "reddit", 4, 4),
    }
    scores = {
        r.author_id: r for r in graph.influence_scores(nodes, graph.weighted_edges(edges)).collect()
    }
    assert (scores["a"].in_degree, scores["a"].out_degree) == (0, 1)
    assert (scores["lone"].in_degree, scores["lone"].out_degree) == (0, 0)
    assert scores["ghost"].amplification_risk_score == 0.0
    lone = scores["lone"]
    assert math.isclose(
        lone.amplification_risk_score, lone.pagerank_score * (1 + math.log1p(4)) * 1000
    )


def test_risk_without_posts_is_zero(spark):
    row = spark.range(1).select(graph.amplification_risk(F.lit(0.5), F.lit(0), F.lit(0))).first()
    assert row[0] == 0.0


def test_export(spark, tmp_path, small):
    nodes, edges, rows = small
    graph.export_graph(nodes, edges, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/edges").count() == len(rows)


def test_salted_join_equals_plain_join(spark):
    rng = random.Random(3)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rng.randint(0, 40)}") for i in range(3000)]
    rows += [(9001, None)]
    big = spark.createDataFrame(rows, "i int, k string")
    keys = sorted({k for _, k in rows if k})
    small = spark.createDataFrame([(k, j) for j, k in enumerate(keys + ["extra"])], "k string, j int")
    hot = find_hot_keys(big, "k", min_rows=100)
    assert [r.k for r in hot.splits.collect()] == ["hot"]
    spread = hot.spread(big, ["i"]).filter("k = 'hot'").select("_salt").distinct().count()
    assert spread > 1
    assert find_hot_keys(big, "k", min_rows=5000).splits is None
    plain = {tuple(r) for r in big.join(small, "k").collect()}
    salted = salted_join(big, small, "k", ["i"], min_rows=100).collect()
    assert len(salted) == len(plain) and {tuple(r) for r in salted} == plain
