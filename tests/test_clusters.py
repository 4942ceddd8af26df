"""Network clusters against modularity worked out by hand and against label propagation."""

from collections import defaultdict

import pytest

from postlens.operators import clusters, graph
from postlens.plans.catalog import week_graph
from postlens.sources.adapters import Tables


def frames(spark, names, pairs):
    nodes = spark.createDataFrame([(n,) for n in names], "author_id string")
    return nodes, spark.createDataFrame([(a, b, 1.0) for a, b in pairs], "src string, dst string, weight double")


def modularity(group, pairs):
    links = {frozenset(p) for p in pairs if p[0] != p[1]}
    inside, ends = defaultdict(int), defaultdict(int)
    for link in links:
        a, b = (group[n] for n in link)
        ends[a] += 1
        ends[b] += 1
        inside[a] += a == b
    return sum(inside[g] / len(links) - (ends[g] / 2 / len(links)) ** 2 for g in ends)


def test_rings_of_cliques(spark):
    """Six cliques of five in a ring, a pair given both ways, a self link and a lone author; hubs and groups are split."""
    names = [f"{c}{k}" for c in "abcdef" for k in range(5)] + ["lone"]
    pairs = [(f"{c}{i}", f"{c}{j}") for c in "abcdef" for i in range(5) for j in range(i)]
    pairs += [(f"{c}0", f"{d}1") for c, d in zip("abcdef", "bcdefa")] + [("a0", "a1"), ("a1", "a0"), ("b0", "b0")]
    rows = clusters.network_clusters(*frames(spark, names, pairs), min_hot_rows=4).collect()
    group = {r.author_id: r.network_cluster_id for r in rows}
    assert len(rows) == len(names) and sorted(set(group.values())) == list(range(7))
    assert all(len({group[f"{c}{k}"] for k in range(5)}) == 1 for c in "abcdef")
    assert rows[0].modularity == pytest.approx(modularity(group, pairs))


def test_no_links_and_no_authors(spark):
    nodes, edges = frames(spark, ["x", "y"], [])
    assert sorted(r.network_cluster_id for r in clusters.network_clusters(nodes, edges).collect()) == [0, 1]
    assert clusters.network_clusters(nodes.limit(0), edges).collect() == []


def test_influence_rows_keep_authors_without_a_cluster(spark):
    scores = spark.createDataFrame([("a", 1.0), ("z", 2.0), (None, 3.0)], "author_id string, pagerank_score double")
    found = spark.createDataFrame([("a", 4, 0.5)], "author_id string, network_cluster_id int, modularity double")
    rows = {r.author_id: r.network_cluster_id for r in clusters.with_clusters(scores, found).collect()}
    assert rows == {"a": 4, "z": None, None: None}


def test_modularity_of_the_reply_graph_is_not_under_label_propagation(spark):
    nodes, edges = week_graph(Tables(spark, "/root/testdata/sf0.01"))
    rows = clusters.network_clusters(nodes, edges).collect()
    group = {r.author_id: r.network_cluster_id for r in rows}
    pairs = [(r.src, r.dst) for r in edges.collect()]
    assert len(rows) == nodes.count()
    assert rows[0].modularity == pytest.approx(modularity(group, pairs))
    (spread,) = graph.modularity(edges, graph.communities(nodes, edges)).first()
    assert rows[0].modularity >= spread
