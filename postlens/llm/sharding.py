"""Shards from a consistent-hash ring with virtual nodes and bounded loads."""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import ranked, stored

SHARDS = 24
VIRTUAL_NODES = 128


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> tuple[np.ndarray, np.ndarray]:
    """Places of all virtual nodes on the ring, ascending, and the shard of each.

    A node's place depends on its shard and number only, so a ring with one more shard has the same nodes and some more.
    """
    nodes = sorted(
        (int.from_bytes(hashlib.blake2b(f"{shard}:{node}".encode(), digest_size=8).digest(), "big") >> 1, shard)
        for shard in range(shards)
        for node in range(virtual_nodes)
    )
    return np.array([n[0] for n in nodes], dtype=np.int64), np.array([n[1] for n in nodes], dtype=np.int64)


def bounded_plan(loads: np.ndarray, owners: np.ndarray, shards: int) -> list[tuple[int, int, int, int]]:
    """(arc, first rank, shard, first slot) from the number of keys on each arc of the ring.

    A shard takes total // shards keys, the first total % shards of them one more. First every arc gives
    its own shard what that has room for, in ring order; then the rest of each arc goes on clockwise, and
    every shard it meets takes what it has room for. The room is just the number of keys, so all are placed.
    """
    total = int(loads.sum())
    room = np.array([total // shards + (shard < total % shards) for shard in range(shards)])
    slots = np.zeros(shards, dtype=np.int64)
    runs, over = [], []

    def give(arc, rank, shard, wanted):
        taken = int(min(wanted, room[shard]))
        if taken:
            runs.append((arc, rank, int(shard), int(slots[shard])))
            room[shard] -= taken
            slots[shard] += taken
        return taken

    for arc, load in enumerate(loads.tolist()):
        taken = give(arc, 0, owners[arc], load)
        if taken < load:
            over.append((arc, taken, load))
    for arc, rank, load in over:
        at = arc
        while rank < load:
            at = (at + 1) % len(owners)
            rank += give(arc, rank, owners[at], load - rank)
    return runs


def shard_documents(docs: DataFrame, shards: int = SHARDS, virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """doc_id, size, text_crc32, arc, shard, slot of every row, by the law `rows`: counts at most one apart.

    A key's place is the hash of doc_id and it belongs to the next node clockwise. Only the keys on each arc
    (shards * virtual_nodes numbers) come to the driver; keys then take planned slots by their rank within the arc, which is
    made from salted groups as repeated doc_ids share an arc. Null texts have no bytes, a null doc_id is a key
    of its own, repeated rows count one by one, and an empty table gives no rows. Other columns are left out.
    """
    spark = docs.sparkSession
    places, owners = ring(shards, virtual_nodes)

    @F.pandas_udf("int")
    def arc_of(hashes: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(places, hashes.to_numpy(), side="left") % len(places))

    body = F.coalesce("text", F.lit("")).cast("binary")
    keys = stored(
        docs.select(
            "doc_id",
            (F.octet_length(body) + 8).cast("bigint").alias("size"),
            F.crc32(body).alias("text_crc32"),
            arc_of(F.shiftrightunsigned(F.xxhash64("doc_id"), 1)).alias("arc"),
        ),
        "shard-keys",
    )
    loads = np.zeros(len(owners), dtype=np.int64)
    for row in keys.groupBy("arc").agg(F.count("*").alias("n")).collect():
        loads[row.arc] = row.n
    by_arc = {}
    for arc, *run in bounded_plan(loads, owners, shards):
        by_arc.setdefault(arc, []).append(run)
    rows = [(arc, *map(list, zip(*runs))) for arc, runs in by_arc.items()]
    plan = spark.createDataFrame(rows, "arc int, _ranks array<bigint>, _shards array<int>, _slots array<bigint>")
    placed = ranked(keys, ["arc"], ["doc_id", "text_crc32", "size"], "_rank").join(F.broadcast(plan), "arc")
    run = F.col("_run")
    return placed.withColumn("_run", F.expr("int(size(filter(_ranks, r -> r <= _rank)))")).select(
        "doc_id",
        "size",
        "text_crc32",
        "arc",
        F.element_at("_shards", run).alias("shard"),
        (F.element_at("_slots", run) + F.col("_rank") - F.element_at("_ranks", run)).alias("slot"),
    )
