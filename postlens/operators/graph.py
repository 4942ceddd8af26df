"""The reply graph: edges, degrees, PageRank, amplification risk and communities.

Nodes and edges are DataFrames. The iterative jobs keep edges partitioned by source in reliable
storage, so a round shuffles only map-side combined sums. Every round ends in a checkpoint of
node-sized data: the next plan starts from files, and a lost executor costs one round at most.
Out-links of a hub are split over salts; a hub's in-links are combined before the shuffle.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.functions.numeric import rounded
from postlens.operators.filters import HIGH_RISK, lookback
from postlens.operators.metrics import author_sentiment
from postlens.operators.skew import MIN_ROWS, HotKeys, find_hot_keys, salted_join
from postlens.session import cut_lineage, fixed_partitioning

DELETED = "[deleted]"


def reply_edges(
    raw: DataFrame,
    lookback_days: int = 7,
    as_of=None,
    keep_deleted: bool = False,
    min_hot_rows: int = MIN_ROWS,
) -> DataFrame:
    """Replies per (source, target, handles) for replies written in the look-back period.

    The post answered may be older. Replies to oneself are dropped.
    """
    replies = (
        lookback(raw, f"{lookback_days} days", as_of)
        .filter(F.col("reply_to_id").isNotNull())
        .select(
            F.col("reply_to_id").alias("target_post"),
            F.col("post_id").alias("reply_post"),
            F.col("author_id").alias("source_user"),
            F.col("author_handle").alias("source_handle"),
        )
    )
    answered = raw.select(
        F.col("post_id").alias("target_post"),
        F.col("author_id").alias("target_user"),
        F.col("author_handle").alias("target_handle"),
    )
    pairs = salted_join(
        replies, answered, "target_post", ["reply_post"], min_rows=min_hot_rows
    ).filter(F.col("source_user") != F.col("target_user"))
    if not keep_deleted:
        pairs = pairs.filter(
            ~F.col("source_user").endswith(DELETED) & ~F.col("target_user").endswith(DELETED)
        )
    return pairs.groupBy("source_user", "source_handle", "target_user", "target_handle").agg(
        F.count(F.lit(1)).alias("interaction_count")
    )


def mention_edges(posts: DataFrame, raw: DataFrame, text: str = "raw_text") -> DataFrame:
    """Who names whose handle in a post."""
    handles = raw.select(
        F.col("author_id").alias("target_user"),
        F.ltrim(F.col("author_handle"), F.lit("@")).alias("handle"),
    ).distinct()
    named = posts.select(
        "post_id",
        F.col("author_id").alias("source_user"),
        F.explode(
            F.array_distinct(
                F.regexp_extract_all(F.col(text), F.lit(r"@([\p{L}\p{N}_.-]+)"), F.lit(1))
            )
        ).alias("handle"),
    )
    return (
        salted_join(named, handles, "handle", ["post_id"])
        .filter(F.col("source_user") != F.col("target_user"))
        .groupBy("source_user", "target_user")
        .agg(F.count(F.lit(1)).alias("interaction_count"))
    )


def weighted_edges(edges: DataFrame) -> DataFrame:
    """One row (src, dst, weight) per pair; weights of all handles of a pair are added."""
    return edges.groupBy(
        F.col("source_user").alias("src"), F.col("target_user").alias("dst")
    ).agg(F.sum("interaction_count").cast("double").alias("weight"))


def author_nodes(author_stats: DataFrame) -> DataFrame:
    """One row per author: counts added, handle and platform those of most posts."""
    return author_stats.groupBy("author_id").agg(
        F.max_by("author_handle", F.struct("total_posts", "author_handle")).alias("handle"),
        F.max_by("platform", F.struct("total_posts", "platform")).alias("platform"),
        F.sum("total_posts").alias("total_posts"),
        F.sum("negative_posts").alias("negative_posts"),
    )


def build_nodes(author_stats: DataFrame, edges: DataFrame) -> DataFrame:
    """Authors with posts, plus authors seen only on an edge (1 post, 0 negative)."""
    ends = edges.select(F.col("source_user").alias("author_id"), F.col("source_handle").alias("h"))
    ends = ends.unionAll(edges.select("target_user", "target_handle"))
    known = author_nodes(author_stats)
    return (
        ends.groupBy("author_id")
        .agg(F.max("h").alias("edge_handle"))
        .join(known, "author_id", "full")
        .select(
            "author_id",
            F.coalesce("handle", "edge_handle", "author_id").alias("author_handle"),
            F.coalesce("platform", F.lit("bluesky")).alias("platform"),
            F.coalesce("total_posts", F.lit(1).cast("bigint")).alias("total_posts"),
            F.coalesce("negative_posts", F.lit(0).cast("bigint")).alias("negative_posts"),
        )
    )


def degrees(edges: DataFrame) -> DataFrame:
    """Distinct neighbours in and out of every author on an edge. edges: src, dst, one per pair."""
    # Sending both ends through one aggregation needs one shuffle in place of three.
    ends = edges.select(
        F.explode(
            F.array(
                F.struct(F.col("src").alias("author_id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
                F.struct(F.col("dst").alias("author_id"), F.lit(0).alias("o"), F.lit(1).alias("i")),
            )
        ).alias("end")
    )
    return ends.groupBy("end.author_id").agg(
        F.sum("end.i").alias("in_degree"), F.sum("end.o").alias("out_degree")
    )


def split_by_source(edges: DataFrame, partitions: int, min_rows: int) -> tuple[DataFrame, HotKeys]:
    """Edges in reliable storage, partitioned by source (and salt of hot sources)."""
    stored = cut_lineage(edges.repartition(partitions, "src"))
    hot = find_hot_keys(stored.select("src"), "src", min_rows)
    if hot.splits is None:
        return stored, hot
    salted = hot.spread(stored, ["dst"])
    return cut_lineage(salted.repartition(partitions, *hot.join_columns)), hot


def pagerank(
    nodes: DataFrame,
    edges: DataFrame,
    damping: float = 0.85,
    max_iter: int = 100,
    tol: float = 1e-5,
    min_hot_rows: int = MIN_ROWS,
) -> DataFrame:
    """Weighted PageRank: author_id, rank, converged, iterations.

    nodes: author_id, one row each, holding every edge end. edges: src, dst, weight. Rank of
    authors without out-links is spread over all. It stops when the summed change is below
    nodes * tol, or after max_iter rounds (tol 0 always does all rounds).
    """
    stored = cut_lineage(edges)
    with fixed_partitioning(nodes.sparkSession, stored.count()) as partitions:
        return _pagerank(nodes, stored, damping, max_iter, tol, min_hot_rows, partitions)


def _pagerank(nodes, edges, damping, max_iter, tol, min_hot_rows, partitions):
    split, hot = split_by_source(edges, partitions, min_hot_rows)
    out_weight = split.groupBy("src").agg(F.sum("weight").alias("out_weight"))
    base = cut_lineage(
        nodes.select(F.col("author_id").alias("src"))
        .repartition(partitions, "src")
        .join(out_weight, "src", "left")
    )
    total, sinks = base.agg(
        F.count(F.lit(1)), F.count_if(F.col("out_weight").isNull())
    ).first()
    ranks = base.withColumn("rank", F.lit(1.0) / F.lit(float(max(total, 1))))
    dangling = sinks / max(total, 1)
    converged = total == 0
    rounds = 0
    while rounds < max_iter and not converged:
        rounds += 1
        sent = hot.repeat(ranks.select("src", (F.col("rank") / F.col("out_weight")).alias("r")))
        received = (
            split.join(sent, hot.join_columns)
            .groupBy(F.col("dst").alias("src"))
            .agg(F.sum(F.col("r") * F.col("weight")).alias("got"))
        )
        spread = (1.0 - damping) / total + damping * dangling / total
        step = cut_lineage(
            ranks.join(received, "src", "left").select(
                "src",
                "out_weight",
                (F.lit(damping) * F.coalesce("got", F.lit(0.0)) + F.lit(spread)).alias("next"),
                F.col("rank").alias("before"),
            )
        )
        # One row comes back: what the next round and the stop test need.
        dangling, change = step.agg(
            F.coalesce(F.sum(F.when(F.col("out_weight").isNull(), F.col("next"))), F.lit(0.0)),
            F.sum(F.abs(F.col("next") - F.col("before"))),
        ).first()
        converged = change < total * tol
        ranks = step.select("src", "out_weight", F.col("next").alias("rank"))
    return ranks.select(
        F.col("src").alias("author_id"),
        "rank",
        F.lit(converged).alias("converged"),
        F.lit(rounds).alias("iterations"),
    )


def amplification_risk(rank, negative, total):
    """rank * (1 + ln(1 + negative)) * (negative / total)^1.2 * 1000; 0 for no posts."""
    share = F.when(total > 0, negative / total).otherwise(F.lit(0.0))
    return rank * (1.0 + F.log1p(negative)) * F.pow(share, F.lit(1.2)) * 1000.0


def influence_scores(nodes: DataFrame, edges: DataFrame, **pagerank_options) -> DataFrame:
    """PageRank, degrees and risk per author. nodes: build_nodes; edges: weighted_edges."""
    ranked = pagerank(nodes, edges, **pagerank_options)
    negative, total = F.col("negative_posts"), F.col("total_posts")
    return (
        nodes.join(ranked, "author_id")
        .join(degrees(edges), "author_id", "left")
        .select(
            "author_id",
            "author_handle",
            "platform",
            F.col("rank").alias("pagerank_score"),
            F.coalesce("in_degree", F.lit(0)).cast("bigint").alias("in_degree"),
            F.coalesce("out_degree", F.lit(0)).cast("bigint").alias("out_degree"),
            "total_posts",
            "negative_posts",
            rounded(F.when(total > 0, negative / total).otherwise(F.lit(0.0)), 3).alias(
                "negative_ratio"
            ),
            amplification_risk(F.col("rank"), negative, total).alias("amplification_risk_score"),
        )
    )


def reply_graph(raw: DataFrame, posts: DataFrame, lookback_days=7, as_of=None):
    """(nodes, edges) of the look-back period, each worked out once."""
    pairs = cut_lineage(reply_edges(raw, lookback_days, as_of))
    nodes = cut_lineage(build_nodes(author_sentiment(posts, lookback_days, as_of), pairs))
    return nodes, weighted_edges(pairs)


def run_influence(raw: DataFrame, posts: DataFrame, lookback_days=7, as_of=None, **options):
    """Scores of the look-back period's reply graph. Empty in, empty out."""
    return influence_scores(*reply_graph(raw, posts, lookback_days, as_of), **options)


def undirected(edges: DataFrame) -> DataFrame:
    """Each linked pair once per direction, without weights."""
    return (
        edges.select(
            F.explode(
                F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
            ).alias("e")
        )
        .select("e.src", "e.dst")
        .filter(F.col("src") != F.col("dst"))
        .distinct()
    )


def communities(nodes: DataFrame, edges: DataFrame, min_hot_rows: int = MIN_ROWS) -> DataFrame:
    """author_id, community_id, converged, iterations by label propagation on the undirected graph.

    Every round each author takes the label most frequent among itself and its neighbours, the
    smallest one on a tie; all authors change at once. It ends when no label changes. Two groups of
    authors may swap labels for ever: labels equal to those of two rounds before end it as well,
    and converged is false then.
    """
    links = cut_lineage(undirected(edges))
    with fixed_partitioning(nodes.sparkSession, links.count()) as partitions:
        return _communities(nodes, links, min_hot_rows, partitions)


def _communities(nodes, links, min_hot_rows, partitions):
    split, hot = split_by_source(links, partitions, min_hot_rows)
    state = cut_lineage(
        nodes.select(
            F.col("author_id").alias("src"),
            F.col("author_id").alias("label"),
            F.lit(None).cast("string").alias("before"),
        ).repartition(partitions, "src")
    )
    rounds, changed, repeated = 0, 1, 0
    while changed and not repeated:
        rounds += 1
        labels = state.select("src", "label")
        votes = (
            split.join(hot.repeat(labels), hot.join_columns)
            .select(F.col("dst").alias("src"), "label")
            .unionAll(labels)
            .groupBy("src", "label")
            .agg(F.count(F.lit(1)).alias("votes"))
        )
        # Most votes, then smallest label, as an aggregate: partial results per task.
        chosen = votes.groupBy("src").agg(
            F.min(F.struct((-F.col("votes")).alias("v"), "label")).getField("label").alias("label")
        )
        last = state.select("src", F.col("label").alias("one_back"), F.col("before").alias("two_back"))
        step = cut_lineage(last.join(chosen, "src"))
        changed, differs = step.agg(
            F.count_if(F.col("label") != F.col("one_back")),
            F.count_if(~F.col("label").eqNullSafe(F.col("two_back"))),
        ).first()
        repeated = not differs
        state = step.select("src", "label", F.col("one_back").alias("before"))
    return state.select(
        F.col("src").alias("author_id"),
        F.col("label").alias("community_id"),
        F.lit(not changed).alias("converged"),
        F.lit(rounds).alias("iterations"),
    )


def modularity(edges: DataFrame, members: DataFrame) -> DataFrame:
    """One row: communities and the modularity of the undirected, unweighted graph."""
    ends = cut_lineage(undirected(edges))
    a = members.select(F.col("author_id").alias("src"), F.col("community_id").alias("c"))
    b = members.select(F.col("author_id").alias("dst"), F.col("community_id").alias("d"))
    with_source = salted_join(ends, a, "src", ["dst"])
    per_community = (
        salted_join(with_source, b, "dst", ["src"])
        .groupBy("c")
        .agg(
            F.count_if(F.col("c") == F.col("d")).alias("inside"),
            F.count(F.lit(1)).alias("ends"),
        )
    )
    links = F.col("links")
    return (
        per_community.agg(
            F.sum("ends").alias("links"),
            F.sum("inside").alias("inside"),
            F.sum(F.col("ends").cast("double") * F.col("ends")).alias("squares"),
        )
        .select(rounded(F.col("inside") / links - F.col("squares") / links / links, 6).alias("modularity"))
    )


def community_summary(members: DataFrame, scores: DataFrame) -> DataFrame:
    """Size and share of negative posts per community, largest first."""
    return (
        members.join(scores, "author_id", "left")
        .groupBy("community_id")
        .agg(
            F.count(F.lit(1)).alias("members"),
            rounded(
                F.coalesce(F.sum("negative_posts"), F.lit(0))
                / F.greatest(F.lit(1), F.coalesce(F.sum("total_posts"), F.lit(0))),
                4,
            ).alias("negative_ratio"),
        )
        .orderBy(F.desc("members"), "community_id")
    )


def members_of(scores: DataFrame, members: DataFrame, community_id) -> DataFrame:
    """Score rows of the authors in one community."""
    chosen = members.filter(F.col("community_id") == community_id)
    return scores.join(chosen, "author_id", "left_semi")


def high_risk(scores: DataFrame, limit: float = HIGH_RISK) -> DataFrame:
    return scores.filter(F.col("amplification_risk_score") >= limit)


def export_graph(nodes: DataFrame, edges: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Node and edge tables side by side under path."""
    nodes.write.format(fmt).mode("overwrite").save(f"{path}/nodes")
    edges.write.format(fmt).mode("overwrite").save(f"{path}/edges")
