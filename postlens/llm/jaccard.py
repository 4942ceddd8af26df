"""Documents linked by the Jaccard similarity of their word shingles, and the components of these links.

Documents with one shingle set are one node. Nodes that may be linked meet at a shingle of their prefixes;
there an R-tree over count vectors bounds the overlap of pairs and the survivors are verified on whole sets.
"""

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import per_worker, stored
from postlens.session import cut_lineage, fixed_partitioning, shuffle_partitions, small_batches

SHINGLE_WORDS = 5
# Linked: 100 * intersection >= 75 * union. Every bound below follows from these two numbers.
SHARE, WHOLE = 75, 100
# A prefix is longer by size // EXTRA than needed for one common shingle, so partners share as many more.
EXTRA = 16
# Shingles that come last in the order of prefixes. Any choice gives the same links; common ones make small blocks.
FREQUENT_SHINGLES = 1 << 17
FREQUENT_IN_BATCH = 0.0004
FREQUENT_AT_LEAST = 4
FREQUENT_ROWS = 10_000
# Nodes of a block are compared with so many of its members first; the rest of a block only across components.
PIVOTS = 8
BLOCK_SHINGLES = 1 << 21
FANOUT = 8
PAIRS_AT_ONCE = 1 << 14
# All pairs of a component are counted: so many nodes at most in a chunk, nodes compared at once, shingles at once.
COUNTED_NODES = 1 << 13
TILE_NODES = 1 << 10
TILE_SHINGLES = 1 << 12
# Bits of the sieve that spares the last reading of texts most of the work.
SIEVE_BITS = 1 << 27

LOWER = bytes(byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))
SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
BASE = 0x9E3779B97F4A7C15
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Shingler:
    """Shingle sets of texts as ascending arrays of 64-bit hashes, worked out over bytes in numpy."""

    def __init__(self):
        self.letters = mixed(np.arange(1, 257, dtype=np.uint64) * U(BASE))
        self.grow(1 << 16)

    def grow(self, size):
        """Powers of the base and of its inverse modulo 2^64."""

        def powers(base):
            factors = np.full(size + 1, base, dtype=np.uint64)
            factors[0] = 1
            return np.cumprod(factors)

        self.powers, self.inverses = powers(BASE), powers(pow(BASE, -1, 1 << 64))

    def words(self, text: str) -> np.ndarray:
        """A hash of every word: runs of anything but white space bytes, A to Z in lower case."""
        data = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(LOWER), dtype=np.uint8)
        if len(data) >= len(self.powers):
            self.grow(2 * len(data))
        space = np.concatenate([[True], SPACE[data], [True]])
        starts = np.flatnonzero(space[:-1] & ~space[1:])
        ends = np.flatnonzero(~space[:-1] & space[1:])
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(self.letters[data] * self.powers[: len(data)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.inverses[starts] + (ends - starts).astype(np.uint64))

    def __call__(self, text: str | None) -> np.ndarray:
        words = self.words(text) if text else np.empty(0, dtype=np.uint64)
        size = min(SHINGLE_WORDS, len(words))
        if not size:
            return words
        shingles = np.full(len(words) - size + 1, size, dtype=np.uint64)
        for k in range(size):
            shingles = mixed(shingles * U(BASE) + words[k : k + len(shingles)])
        return np.unique(shingles)


def shingler() -> Shingler:
    return per_worker("shingler", Shingler)


def node_of(shingles: np.ndarray) -> int:
    """A 64-bit name of a set: N sets get two equal names with a chance of about N^2 / 2^65."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_overlap(a, b):
    """The least intersection of linked sets of these sizes."""
    return -(-SHARE * (a + b) // (WHOLE + SHARE))


def prefix_size(n: int) -> int:
    return n - -(-SHARE * n // WHOLE) + max(1, n // EXTRA)


def count_vector(shingles: np.ndarray) -> np.ndarray:
    """How many shingles fall into each group by their top bits; the number of groups grows with the set."""
    bits = max(4, int(len(shingles) // 4).bit_length())
    return np.bincount((shingles >> U(64 - bits)).astype(np.int64), minlength=1 << bits)


def vector_bytes(vector: np.ndarray) -> bytes:
    """Counts in one byte each, or in four if one is over 255; the last byte tells which."""
    wide = int(vector.max(initial=0) > 255)
    return vector.astype("<u4" if wide else np.uint8).tobytes() + bytes([wide])


def vector_of(data: bytes) -> np.ndarray:
    return np.frombuffer(data[:-1], dtype="<u4" if data[-1] else np.uint8)


def folded(vector: np.ndarray, size: int) -> np.ndarray:
    """The vector of fewer groups: neighbours added up."""
    return vector.reshape(size, -1).sum(axis=1, dtype=np.int64)


# --- passes over the texts -------------------------------------------------------------------


def common_among(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that FREQUENT_AT_LEAST and FREQUENT_IN_BATCH of the sets have, and in how many; one sorted copy is held."""
    least = math.ceil(max(FREQUENT_AT_LEAST, FREQUENT_IN_BATCH * len(sets)))
    flat = np.concatenate([*sets, np.empty(0, np.uint64)])
    flat.sort()
    common = np.unique(flat[least - 1 :][flat[least - 1 :] == flat[: max(0, len(flat) - least + 1)]])
    return common, np.searchsorted(flat, common, "right") - np.searchsorted(flat, common, "left")


def node_rows(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, node (null for an empty set), and on some rows shingles common among FREQUENT_ROWS with counts."""

    def rows(batches):
        make = shingler()
        ids, sizes, nodes, different = [], [], [], {}

        def found():
            common, counts = common_among([*different.values()])
            on_last = lambda values: pa.array([*[None] * (len(sizes) - 1), values], pa.list_(pa.int64()))
            columns = [
                pa.array(ids, pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(nodes, pa.int64()),
                on_last(common.view(np.int64)),
                on_last(counts),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "node", "common", "counts"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                own = make(text.as_py())
                node = node_of(own) if len(own) else None
                ids.append(doc_id.as_py())
                sizes.append(len(own))
                nodes.append(node)
                if node is not None:
                    different[node] = own
                if len(sizes) >= FREQUENT_ROWS:
                    yield found()
                    ids, sizes, nodes, different = [], [], [], {}
        if sizes:
            yield found()

    schema = "doc_id bigint, n_shingles bigint, node bigint, common array<bigint>, counts array<bigint>"
    return docs.mapInArrow(rows, schema)


def frequent_shingles(nodes: DataFrame) -> np.ndarray:
    """The most frequent shingles by what batches counted, FREQUENT_SHINGLES at most."""
    pairs = nodes.where("size(common) > 0").select(F.explode(F.arrays_zip("common", "counts")).alias("c"))
    sums = pairs.groupBy("c.common").agg(F.sum("c.counts").alias("n"))
    top = sums.orderBy(F.desc("n"), "common").limit(FREQUENT_SHINGLES).select("common").toPandas()["common"]
    return np.sort(top.to_numpy(dtype=np.int64).view(np.uint64))


def prefix_rows(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """shingle, node, n: the first shingles of every set, frequent ones last and by hash within both kinds.

    Copies within a batch give their rows once.
    """
    last = docs.sparkSession.sparkContext.broadcast(frequent)

    def rows(batches):
        make = shingler()
        for batch in batches:
            shingles, nodes, sizes = [np.empty(0, np.uint64)], [], []
            seen = set()
            for text in batch.column("text"):
                own = make(text.as_py())
                node = node_of(own)
                if not len(own) or node in seen:
                    continue
                seen.add(node)
                place = np.searchsorted(last.value, own)
                is_last = np.zeros(len(own), dtype=bool)
                inside = place < len(last.value)
                is_last[inside] = last.value[place[inside]] == own[inside]
                shingles.append(np.concatenate([own[~is_last], own[is_last]])[: prefix_size(len(own))])
                nodes.append(node)
                sizes.append(len(own))
            counts = [len(s) for s in shingles[1:]]
            columns = [
                np.concatenate(shingles).view(np.int64),
                np.repeat(np.array(nodes, dtype=np.int64), counts),
                np.repeat(np.array(sizes, dtype=np.int64), counts),
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shingle", "node", "n"])

    return docs.select("text").mapInArrow(rows, "shingle bigint, node bigint, n bigint")


def sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, vector, shingles (both binary) of the wanted nodes, from one document of each; partitioned by node.

    The number of partitions is fixed here, so the written rows stay where they are in every join by node.
    A sieve of SIEVE_BITS bits, whatever the tables' size, tells most of the other documents apart before any work is
    done on them; what it lets through too many goes in the join.
    """
    # From 1, as Spark gives place 0 a bucket of its own.
    place = F.pmod(F.xxhash64("doc_id"), F.lit(SIEVE_BITS)) + 1
    chosen = nodes.join(wanted.select("node"), "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    bits = chosen.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b"))
    sieve = {r.b: bytes(r.m) for r in bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m")).collect()}
    sieve = docs.sparkSession.sparkContext.broadcast(sieve)

    def rows(batches):
        make = shingler()
        for batch in batches:
            out = []
            for at, text in zip(batch.column("p").to_pylist(), batch.column("text")):
                # Bucket b has bits 32768 (b - 1) + 1 to 32768 b, as bitmap_bit_position counts from 1.
                bucket, bit = at // 32768 + 1, at % 32768 - 1
                if at % 32768 == 0:
                    bucket, bit = at // 32768, 32767
                found = sieve.value.get(bucket)
                if found is not None and found[bit >> 3] >> (bit & 7) & 1:
                    own = make(text.as_py())
                    if len(own):
                        out.append((node_of(own), vector_bytes(count_vector(own)), own.tobytes()))
            columns = zip(*out) if out else [[]] * 3
            types = [pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["node", "vector", "shingles"])

    found = docs.select(place.alias("p"), "text").mapInArrow(rows, "node bigint, vector binary, shingles binary")
    found = found.repartition(shuffle_partitions(docs.sparkSession), "node")
    return found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"])


# --- blocks, bounds and verification ------------------------------------------------------------


def with_pivots(rows: DataFrame) -> DataFrame:
    """shingle, node, n, pivot, pivot_n of every node, once, in blocks of two or more; a pivot is its own.

    The pivot is the first node of the block in one of PIVOTS orders, so a node of a large group of near copies meets as
    many different ones. Rows pass by their pivot in a sorted stream, copies of a row beside each other.
    """
    order = F.xxhash64("node", F.col("shingle").bitwiseAND(PIVOTS - 1))
    ordered = Window.partitionBy("shingle").orderBy(order, "node")
    block = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns(
        {"pivot": F.first("node").over(block), "pivot_n": F.first("n").over(block), "next": F.lead("node").over(ordered)}
    )
    # The last copy of a row stays. A pivot with nothing behind it is alone.
    alone = (F.col("node") == F.col("pivot")) & F.col("next").isNull()
    return rows.where(~F.col("next").eqNullSafe(F.col("node")) & ~alone).drop("next")


def possible(live: DataFrame) -> DataFrame:
    """Nodes, with n, that share enough prefix shingles to have any partner.

    A partner has SHARE percent of n shingles at least, and its prefix is longer by its own size // EXTRA.
    """
    needed = F.greatest(F.lit(1), F.ceil(F.col("n") * SHARE / WHOLE) / EXTRA).cast("bigint")
    return live.groupBy("node").agg(F.max("n").alias("n"), F.count("*").alias("shared")).where(F.col("shared") >= needed)


def alike(a: str, b: str):
    """Sizes that a link allows."""
    return (WHOLE * F.col(a) >= SHARE * F.col(b)) & (WHOLE * F.col(b) >= SHARE * F.col(a))


def bounded(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs a, b whose count vectors allow a link."""
    vectors = sets.select("node", "vector")
    joined = pairs.select("a", "b").join(vectors.toDF("a", "va"), "a").join(vectors.toDF("b", "vb"), "b")

    def keep(batches):
        for batch in batches:
            mask = []
            for va, vb in zip(batch.column("va"), batch.column("vb")):
                va, vb = vector_of(va.as_py()), vector_of(vb.as_py())
                size = min(len(va), len(vb))
                bound = np.minimum(folded(va, size), folded(vb, size)).sum()
                mask.append(bool(bound >= least_overlap(int(va.sum()), int(vb.sum()))))
            yield batch.select(["a", "b"]).filter(pa.array(mask, pa.bool_()))

    return joined.mapInArrow(keep, "a bigint, b bigint")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs a, b that are linked, by their whole sets."""
    whole = sets.select("node", "shingles")
    joined = pairs.select("a", "b").join(whole.toDF("a", "sa"), "a").join(whole.toDF("b", "sb"), "b")

    def keep(batches):
        for batch in batches:
            mask = []
            for sa, sb in zip(batch.column("sa"), batch.column("sb")):
                sa, sb = np.frombuffer(sa.as_py(), np.uint64), np.frombuffer(sb.as_py(), np.uint64)
                common = len(np.intersect1d(sa, sb, assume_unique=True))
                mask.append(common >= least_overlap(len(sa), len(sb)))
            yield batch.select(["a", "b"]).filter(pa.array(mask, pa.bool_()))

    return joined.mapInArrow(keep, "a bigint, b bigint")


class CountTree:
    """An R-tree, packed level by level, over count vectors with as many groups as the smallest set of the block has.

    An entry of a level keeps the greatest count of every group below it, the least size, and the component if all
    below are of one. The sum of the smaller counts of a query and an entry bounds every overlap below.
    """

    def __init__(self, vectors, components):
        self.sizes = np.array([int(v.sum()) for v in vectors], dtype=np.int64)
        groups = min(map(len, vectors))
        points = np.stack([folded(v, groups) for v in vectors])
        # Neighbours in size and then in their fullest group come under one entry.
        self.vectors = vectors
        order = np.lexsort((points.argmax(axis=1), self.sizes))
        self.order, self.points, self.components = order, points, np.asarray(components)
        level = points[order], self.sizes[order], self.components[order], self.components[order]
        self.levels = [level]
        while len(level[0]) > FANOUT:
            cuts = np.arange(0, len(level[0]), FANOUT)
            level = (
                np.maximum.reduceat(level[0], cuts),
                np.minimum.reduceat(level[1], cuts),
                np.minimum.reduceat(level[2], cuts),
                np.maximum.reduceat(level[3], cuts),
            )
            self.levels.append(level)

    def fits(self, one, other):
        """Whether a pair's own vectors allow a link; the tree's have the groups of the block's smallest set only."""
        a, b = self.vectors[one], self.vectors[other]
        size = min(len(a), len(b))
        bound = np.minimum(folded(a, size), folded(b, size)).sum()
        return bool(bound >= least_overlap(self.sizes[one], self.sizes[other]))

    def pairs(self):
        """Pairs of places in the block, of different components, that the bound allows."""
        for start in range(0, len(self.points), max(1, PAIRS_AT_ONCE // FANOUT)):
            queries = np.arange(start, min(len(self.points), start + max(1, PAIRS_AT_ONCE // FANOUT)))
            top = len(self.levels[-1][0])
            frontier = np.repeat(queries, top), np.tile(np.arange(top), len(queries))
            yield from self.descend(frontier, len(self.levels) - 1)

    def descend(self, frontier, depth):
        highest, least, low, high = self.levels[depth]
        for start in range(0, len(frontier[0]), PAIRS_AT_ONCE):
            q, e = (f[start : start + PAIRS_AT_ONCE] for f in frontier)
            own = self.components[q]
            open_ = (low[e] != own) | (high[e] != own)
            # Each pair is found from its larger set (of equal ones from both): smaller sets bound it as well.
            open_ &= least[e] <= self.sizes[q]
            q, e = q[open_], e[open_]
            bound = np.minimum(self.points[q], highest[e]).sum(axis=1)
            fits = bound >= least_overlap(self.sizes[q], least[e])
            q, e = q[fits], e[fits]
            if not len(q):
                continue
            if depth == 0:
                other = self.order[e]
                size_fits = WHOLE * self.sizes[other] >= SHARE * self.sizes[q]
                yield from zip(q[size_fits].tolist(), other[size_fits].tolist())
            else:
                children = len(self.levels[depth - 1][0])
                below = (e[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                queries = np.repeat(q, FANOUT)[below < children]
                yield from self.descend((queries, below[below < children]), depth - 1)


def across_components(live: DataFrame, parts: DataFrame, sets: DataFrame) -> DataFrame:
    """Links a, b between components, from pairs that share a shingle of their prefixes.

    Texts that are alike meet at many shingles. Blocks with the same least node are put together, so such texts
    are compared once and not at each of them; what comes together without a common shingle costs a bound at most. A
    block with over BLOCK_SHINGLES shingles is dealt out: its nodes fall into chunks and every two chunks meet in a
    task. There the R-tree bounds pairs and whole sets verify them, until the block's components are joined: a
    block gives fewer links than it has nodes.
    """
    block = Window.partitionBy("shingle")
    ends = {"least": F.min("node"), "low": F.min("component"), "high": F.max("component")}
    rows = live.join(parts, "node").withColumns({name: end.over(block) for name, end in ends.items()})
    rows = stored(rows.where("low <> high").select("least", "node", "n", "component").distinct(), "mixed-blocks")
    chunks = rows.groupBy("least").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("chunks"))
    rows = rows.join(chunks, "least").withColumn("own", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    rows = rows.withColumn("other", other).select(
        F.xxhash64("least", F.least("own", "other"), F.greatest("own", "other")).alias("block"), "node", "component"
    )
    rows = rows.distinct()
    # Vectors first: whole sets are sent for the nodes only that have a pair left.
    near = in_blocks(rows.join(sets.select("node", "vector"), "node"), nodes_in_pairs, BLOCK_ROW, ["vector"])
    near = stored(near, "near-nodes").join(sets, "node")
    return in_blocks(near, joining_links, "a bigint, b bigint", ["vector", "shingles"]).distinct()


BLOCK_ROW = "block bigint, node bigint, component bigint"


def in_blocks(rows: DataFrame, function, schema: str, payload: list[str]) -> DataFrame:
    """Rows of function(block, list of (node, component, *payload)) for every block, one block at a time."""
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches):
        block, members = None, []

        def found():
            out = function(block, members) if len(members) > 1 else []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

        for batch in batches:
            for own, *member in zip(*(c.to_pylist() for c in batch.columns)):
                if own != block:
                    yield from found()
                    block, members = own, []
                members.append(member)
        yield from found()

    dealt = rows.select("block", "node", "component", *payload).repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(run, schema)


def nodes_in_pairs(block: int, members: list[list]) -> list[tuple[int, int, int]]:
    """(block, node, component) of the (node, component, vector) in a pair of the R-tree whose own vectors allow a link."""
    nodes, components, vectors = zip(*members)
    tree, inside = CountTree([vector_of(v) for v in vectors], components), set()
    for pair in tree.pairs():
        if not inside.issuperset(pair) and tree.fits(*pair):
            inside.update(pair)
    return [(block, nodes[place], components[place]) for place in sorted(inside)]


def joining_links(block: int, members: list[list]) -> list[tuple[int, int]]:
    """Links between the components of one block's (node, component, vector, shingles), none that joins nothing more."""
    nodes, components, vectors, shingles = zip(*members)
    sets = [np.frombuffer(s, np.uint64) for s in shingles]
    parent = {c: c for c in components}

    def root(c):
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    links, tree = [], CountTree([vector_of(v) for v in vectors], components)
    for i, k in tree.pairs():
        one, other = root(components[i]), root(components[k])
        if one != other and tree.fits(i, k):
            common = len(np.intersect1d(sets[i], sets[k], assume_unique=True))
            if common >= least_overlap(len(sets[i]), len(sets[k])):
                links.append((nodes[i], nodes[k]))
                parent[one] = other
    return links


# --- all links of a component ----------------------------------------------------------------------


def overlaps(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of one with every set of other, as products over the shingles both have."""
    flat, flat_other = np.concatenate(one), np.concatenate(other)
    both = np.intersect1d(flat, flat_other)
    out = np.zeros((len(one), len(other)), dtype=np.int64)

    def places(flat, sets):
        """(row, place in both) of what is in both, by place."""
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        place = np.minimum(np.searchsorted(both, flat), len(both) - 1)
        inside = both[place] == flat
        row, place = row[inside], place[inside]
        order = np.argsort(place, kind="stable")
        return row[order], place[order]

    if not len(both):
        return out
    rows, rows_other = places(flat, one), places(flat_other, other)
    for start in range(0, len(both), TILE_SHINGLES):
        width = min(TILE_SHINGLES, len(both) - start)
        tiles = []
        for sets, (row, place) in ((one, rows), (other, rows_other)):
            low, high = np.searchsorted(place, [start, start + width])
            tile = np.zeros((len(sets), width), dtype=np.float32)
            tile[row[low:high], place[low:high] - start] = 1
            tiles.append(tile)
        out += (tiles[0] @ tiles[1].T).astype(np.int64)
    return out


def link_sums(sets: list[np.ndarray], copies: np.ndarray, sides: np.ndarray, across: bool) -> np.ndarray:
    """For every set the copies of all sets that it is linked with; across: of the other side only.

    Sets come in tiles by size and fullest group, as the R-tree's leaves; a set is compared with those of a tile if the
    greatest counts of the tile allow a link.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    vectors = [count_vector(s) for s in sets]
    groups = min(map(len, vectors))
    points = np.stack([folded(v, groups) for v in vectors])
    order = np.lexsort((points.argmax(axis=1), sizes))
    tiles = [t for side in ((0, 1) if across else (0,)) for t in in_tiles(order[sides[order] == side] if across else order, side)]
    sums = np.zeros(len(sets), dtype=np.int64)
    for k, (side, one) in enumerate(tiles):
        for same, (other_side, other) in enumerate(tiles[k:]):
            if across and side == other_side:
                continue

            def open_(own, tile):
                least = np.maximum(sizes[tile].min(), -(-SHARE * sizes[own] // WHOLE))
                bound = np.minimum(points[own], points[tile].max(axis=0)).sum(axis=1)
                fits = (WHOLE * sizes[own] >= SHARE * sizes[tile].min()) & (SHARE * sizes[own] <= WHOLE * sizes[tile].max())
                return own[fits & (bound >= least_overlap(sizes[own], least))]

            a = open_(one, other)
            b = a if not same else open_(other, one)
            if not len(a) or not len(b):
                continue
            common = overlaps([sets[i] for i in a], [sets[i] for i in b])
            linked = common >= least_overlap(sizes[a][:, None], sizes[b][None, :])
            if not same:
                np.fill_diagonal(linked, False)
                sums[a] += linked @ copies[a]
            else:
                sums[a] += linked @ copies[b]
                sums[b] += linked.T @ copies[a]
    return sums


def in_tiles(order: np.ndarray, side: int) -> list[tuple[int, np.ndarray]]:
    return [(side, order[k : k + TILE_NODES]) for k in range(0, len(order), TILE_NODES)]


def linked_copies(nodes: DataFrame, parts: DataFrame, sets: DataFrame) -> DataFrame:
    """node, linked: documents of other nodes that a node is linked with, for all nodes of components of two or more.

    Every link lies inside a component, so all pairs of a component are all there are. A large component is dealt out: its
    nodes fall into chunks and every two chunks meet in a task, which sums links by node; no pair is written.
    """
    copies = nodes.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"))
    rows = parts.join(copies, "node").join(sets.select("node", F.expr("octet_length(shingles) div 8").alias("n")), "node")
    chunks = rows.groupBy("component").agg(
        F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / COUNTED_NODES)).cast("int").alias("chunks")
    )
    rows = rows.join(chunks, "component").withColumn("own", F.pmod(F.xxhash64("node"), "chunks").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    block = [F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")]
    rows = rows.select("component", *block, "own", "node", "copies").join(sets.select("node", "shingles"), "node")

    def run(batches):
        block, members = None, []

        def counted():
            if len(members) > 1:
                own, nodes, copies, shingles = zip(*members)
                _, low, high = block
                sides = (np.array(own) != low).astype(int)
                sums = link_sums([np.frombuffer(s, np.uint64) for s in shingles], np.array(copies, np.int64), sides, low != high)
                yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sums, pa.int64())], names=["node", "linked"])

        for batch in batches:
            for *key, own, node, copies, shingles in zip(*(c.to_pylist() for c in batch.columns)):
                if key != block:
                    yield from counted()
                    block, members = key, []
                members.append((own, node, copies, shingles))
        yield from counted()

    key = ["component", "low", "high"]
    dealt = rows.select(*key, "own", "node", "copies", "shingles").repartition(*key).sortWithinPartitions(*key)
    return dealt.mapInArrow(run, "node bigint, linked bigint").groupBy("node").agg(F.sum("linked").alias("linked"))


# --- components ------------------------------------------------------------------------------------


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, component (the least node that links reach) for all nodes of links a, b.

    Alternates large and small stars until no edge changes; every round is written, as it is read twice. A node's
    edges are grouped by minima only, so one of very many links is no burden.
    """
    edges = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges, before = stored(edges, name), None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        larger = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        larger = larger.where("a <> b")
        least = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(least, "a")
        smaller = smaller.select(F.col("b").alias("a"), F.col("m").alias("b")).union(smaller.select("a", F.col("m").alias("b")))
        edges = stored(smaller.where("a <> b").distinct(), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def split_pairs(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs a, b of nodes in different components; a node without links is its own."""
    one, other = parts.toDF("a", "ca"), parts.toDF("b", "cb")
    joined = pairs.join(one, "a", "left").join(other, "b", "left")
    return joined.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def all_parts(live_nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """node, component of all nodes, those without links included."""
    joined = live_nodes.select("node").join(parts, "node", "left")
    return joined.select("node", F.coalesce("component", "node").alias("component"))


def joining(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(doc_id, n_shingles, node of every document; links a, b that join nodes to components; sets of all nodes with links).

    The links are verified ones and join all nodes that any chain of links joins; links inside a component that is
    whole already are not looked for here: linked_copies() counts them.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    nodes = stored(node_rows(docs), "shingle-nodes")
    frequent = frequent_shingles(nodes)
    nodes = nodes.select("doc_id", "n_shingles", "node")

    # A block's nodes are written once each, so no later reading has to tell copies apart.
    live = stored(with_pivots(prefix_rows(docs, frequent)).select("shingle", "node", "n"), "prefix-blocks")
    wanted = stored(possible(live), "possible-nodes")
    live = stored(with_pivots(live.join(wanted.select("node"), "node", "left_semi")), "blocks")
    star = live.where("node <> pivot")
    with fixed_partitioning(docs.sparkSession, 0, shuffle_partitions(docs.sparkSession)):
        sets = cut_lineage(sets_of(docs, nodes, wanted))
    if (found := sets.count()) != (needed := wanted.count()):
        raise RuntimeError(f"{found} sets for {needed} nodes")

    # First every node with the pivot it shares most with, then with its other pivots where they are still apart.
    votes = star.where(alike("n", "pivot_n")).groupBy("node", "pivot").agg(F.count("*").alias("votes"))
    votes = stored(votes, "votes")
    best = votes.groupBy("node").agg(F.max(F.struct("votes", "pivot")).alias("best"))
    best = best.select(F.col("node").alias("a"), F.col("best.pivot").alias("b"))
    links = stored(verified(bounded(best, sets), sets), "links")
    parts = components(links)
    ordered = votes.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    more = verified(bounded(split_pairs(ordered, parts), sets), sets)
    links = stored(links.union(more), "links")

    # Now all pairs of a block that are in different components.
    parts = stored(all_parts(wanted, components(links)), "parts")
    return nodes, stored(links.union(across_components(live.select("shingle", "node", "n"), parts, sets)), "links"), sets


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (the least doc_id reachable by links) for every row.

    Null and empty texts and texts without words have no shingles and are linked with nothing: their component is
    their own doc_id. A text of fewer than five words has one shingle. Equal texts are linked; rows that repeat a doc_id are rows
    of their own. A null doc_id takes its component's, and is null if all there are. An empty table gives no rows; other
    columns are left out.
    """
    nodes, links, _ = joining(docs)
    return with_component(nodes, components(links)).select("doc_id", "n_shingles", "component_id")


def jaccard_links(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, n_links (other rows that the row is linked with, equal texts included), component_id for every row.

    All links are counted, also those inside a component. Rows are as in jaccard_components(); those without shingles have none.
    """
    nodes, links, sets = joining(docs)
    parts = stored(components(links), "parts")
    linked = linked_copies(nodes, parts, sets)
    copies = nodes.where("node IS NOT NULL").groupBy("node").agg(F.count("*").alias("copies"))
    counts = copies.join(linked, "node", "left").select("node", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"))
    named = with_component(nodes, parts).join(counts, "node", "left")
    return named.select("doc_id", "n_shingles", F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), "component_id")


def with_component(nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """doc_id, n_shingles, node, component_id (the least doc_id of its component) of every row of nodes."""
    named = nodes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = stored(named, "named-nodes")
    least = named.where("node IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    joined = named.join(least, "component", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", "n_shingles", "node", own.alias("component_id"))


def one_of_each_component(docs: DataFrame) -> DataFrame:
    """The rows of docs whose doc_id is the least of their component, all columns kept.

    Rows without shingles and rows without doc_id stay. Of rows that repeat a doc_id and its text one stays; rows that
    repeat a doc_id with other texts stay or go together, and stay if one of them is the least of its component.
    """
    named = jaccard_components(docs)
    goes = F.coalesce(F.col("doc_id") != F.col("component_id"), F.lit(False))
    verdicts = named.where("doc_id IS NOT NULL").groupBy("doc_id")
    verdicts = verdicts.agg(F.min(goes).alias("goes"), (F.count("*") > 1).alias("repeats")).where("goes OR repeats")
    verdicts = stored(verdicts, "verdicts")
    single = docs.join(verdicts, "doc_id", "left_anti")
    repeated = docs.join(verdicts.where("NOT goes"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(repeated).select(*docs.columns)
