"""Network clusters: modularity moves on the reply graph, with contraction of the groups found.

A level moves nodes between groups until modularity rises no more; its groups are the nodes of the next level. Half of
the nodes, chosen by hash, may move in a round, so that two neighbours seldom swap; a round that lowers modularity is
taken back. Sums are combined in tasks, hub nodes and large groups are split over salts, and each round ends in a
written table of node-sized data. It is not a checkpoint: that keeps what the planner knows of order and constraints, which
doubles with every round of joins on renamed columns until planning takes longer than the work.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postlens.operators.graph import split_by_source, undirected
from postlens.operators.skew import MIN_ROWS, salted_join
from postlens.session import fixed_partitioning, rewritten

LEAST_RISE = 1e-6
STILL_ROUNDS = 2  # rounds without a rise, one for each half, that end a level
NUMBERED_ROWS = 1_000_000


def network_clusters(nodes: DataFrame, edges: DataFrame, min_hot_rows: int = MIN_ROWS) -> DataFrame:
    """author_id, network_cluster_id (gapless from 0), modularity, levels for every author in nodes.

    The graph is undirected and unweighted, as in `graph.modularity`. Authors without a link are clusters of their own.
    An empty graph gives no rows. Equal rises go to the group of the least name, so a rerun gives the same clusters.
    """
    links = rewritten(undirected(edges).withColumn("weight", F.lit(1.0)))
    total = links.count()
    members = nodes.select("author_id", F.col("author_id").alias("node"))
    reached, levels = -1.0, 0
    while total:
        with fixed_partitioning(nodes.sparkSession, links.count()) as partitions:
            found, height = _level(links, float(total), min_hot_rows, partitions)
        if height <= reached + LEAST_RISE:
            break
        reached, levels = height, levels + 1
        joined = members.join(found.withColumnRenamed("src", "node"), "node", "left")
        members = rewritten(joined.select("author_id", F.coalesce("label", "node").alias("node")))
        links = rewritten(_contracted(links, found, min_hot_rows))
    return _numbered(members).select(
        "author_id",
        "network_cluster_id",
        F.lit(max(reached, 0.0)).alias("modularity"),
        F.lit(levels).alias("levels"),
    )


def with_clusters(scores: DataFrame, found: DataFrame) -> DataFrame:
    """Influence rows with network_cluster_id; null for an author that is not in found."""
    return scores.join(found.select("author_id", "network_cluster_id"), "author_id", "left")


def _level(links: DataFrame, total: float, min_hot_rows: int, partitions: int) -> tuple[DataFrame, float]:
    """(src, label of every node; their modularity) of one level, from every node alone."""
    split, hot = split_by_source(links, partitions, min_hot_rows)
    own_link = F.when(F.col("src") == F.col("dst"), F.col("weight")).otherwise(F.lit(0.0))
    ends = split.groupBy("src").agg(F.sum("weight").alias("ends"), F.sum(own_link).alias("inner"))
    # group_ends: the sum of ends over the node's group.
    state = rewritten(
        ends.withColumns({"label": F.col("src"), "group_ends": F.col("ends")}).repartition(partitions, "src")
    )
    # No group can be hot where all nodes together are not.
    may_be_hot = state.count() > min_hot_rows
    best, height, turn, still = state, None, 0, 0
    while True:
        step = rewritten(_proposed(split, hot, state, total, turn))
        reached, moving = step.agg(
            F.sum(F.col("inside") + F.col("inner")) / total - F.sum(F.col("ends") * F.col("group_ends")) / total / total,
            F.count_if(F.col("chosen") != F.col("label")),
        ).first()
        turn += 1
        if height is None or reached > height + LEAST_RISE:
            best, height, still = step.drop("inside", "chosen"), reached, 0
        else:
            still += 1
        if still >= STILL_ROUNDS:
            return best.select("src", "label"), height
        if height is not None and reached < height:
            # The moves that led here did more harm than good together: the other half goes on from the best.
            state = best
        elif moving:
            state = _moved(step, may_be_hot, min_hot_rows)
        else:
            state = step.drop("inside", "chosen")


def _proposed(split, hot, state, total, turn):
    """state with inside (weight to its own group) and chosen (the group of most rise) of every node."""
    shown = state.select("src", "label", "group_ends")
    votes = (
        split.filter(F.col("src") != F.col("dst"))
        .join(hot.repeat(shown), hot.join_columns)
        .select(F.col("dst").alias("src"), "label", "group_ends", "weight")
        .unionByName(shown.withColumn("weight", F.lit(0.0)))
        .groupBy("src", "label")
        .agg(F.sum("weight").alias("weight"), F.first("group_ends").alias("others"))
    )
    mine = state.select("src", "ends", F.col("label").alias("own"))
    stays = F.col("label") == F.col("own")
    others = F.col("others") - F.when(stays, F.col("ends")).otherwise(F.lit(0.0))
    rise = F.col("weight") - F.col("ends") * others / total
    # A node stays on a tie, else the least name wins.
    order = F.struct((-rise).alias("fall"), (~stays).alias("moves"), "label")
    chosen = (
        votes.join(mine, "src")
        .groupBy("src")
        .agg(F.min(order).getField("label").alias("first"), F.sum(F.when(stays, F.col("weight"))).alias("inside"))
    )
    may_move = F.pmod(F.xxhash64("src", F.lit(turn // 2)), F.lit(2)) == turn % 2
    return state.join(chosen, "src").withColumn("chosen", F.when(may_move, F.col("first")).otherwise(F.col("label"))).drop("first")


def _moved(step, may_be_hot, min_hot_rows):
    """The state after all chosen moves."""
    rows = step.select("src", "ends", "inner", F.col("chosen").alias("label"))
    sums = rows.groupBy("label").agg(F.sum("ends").alias("group_ends"))
    joined = salted_join(rows, sums, "label", ["src"], min_hot_rows) if may_be_hot else rows.join(sums, "label")
    return rewritten(joined)


def _contracted(links, found, min_hot_rows):
    """Links between groups; those inside a group become its link to itself, counted from both ends."""
    to = found.select(F.col("src").alias("dst"), F.col("label").alias("to"))
    named = salted_join(salted_join(links, found, "src", ["dst"], min_hot_rows), to, "dst", ["src"], min_hot_rows)
    return named.groupBy(F.col("label").alias("src"), F.col("to").alias("dst")).agg(F.sum("weight").alias("weight"))


def _numbered(members):
    """network_cluster_id from 0 by groups of names: only the counts of the groups meet in one task."""
    names = rewritten(members.select("node").distinct())
    spread = F.pmod(F.xxhash64("node"), F.lit(8 + names.count() // NUMBERED_ROWS))
    salted = names.withColumn("_part", spread)
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    shift = salted.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    shift = shift.select("_part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    place = F.row_number().over(W.partitionBy("_part").orderBy("node")) - 1
    numbers = salted.withColumn("place", place).join(F.broadcast(shift), "_part")
    number = (F.col("place") + F.col("shift")).cast("int")
    return salted_join(members, numbers.select("node", number.alias("network_cluster_id")), "node", ["author_id"])
