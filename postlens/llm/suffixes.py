"""Bytes of texts that lie in a string of LENGTH bytes which also starts earlier, found by sorting suffixes.

1. Anchors. Every string of LENGTH bytes picks the least of its hashed grams, so equal strings pick the same one at the same
   place. Strings in a row that pick one gram are a unit. A string can only be met again in a unit with the same gram, so
   units whose gram stands nowhere else, or only in copies of one unit, need no sorting; copies of a unit lie in the first one.
2. Sorting. The other units, each different one once, are dealt out by gram, and each task sorts the suffixes of its units by
   the difference-cover algorithm: triples at two of three places are sorted and named, the names are sorted in the same way,
   the remaining suffixes follow from the next one's rank, and both are merged. It ends when names stand for LENGTH bytes.
   Equal strings are then neighbours; all but the earliest are covered.
   A gram with very many different units is dealt out over several tasks; what they leave meets once more by string.
3. The runs of each document are joined to its text.

Documents are ordered by doc_id, null first, then by the text's crc32 where doc_ids repeat; of equal rows all but one
count as later. A null text is empty. Texts shorter than LENGTH bytes keep all. An empty table gives no rows. Other columns are not read.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import stored
from postlens.session import small_batches

LENGTH = 100
GRAM = 40
# Windows hashed at a time (about 80 bytes of memory each), units sorted out in one task's memory at a time.
WINDOWS_HELD = 1 << 18
UNITS_HELD = 1 << 18
UNITS_A_BUCKET = 200_000
# Different units of one gram that one task sorts; more are dealt out over several.
UNITS_SORTED = 20_000
UNITS_A_TASK = 6_000
UNIT = np.dtype([("fp", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("tie", "<u4"), ("start", "<u4"), ("size", "<u2")])
NO_ID = -(1 << 63)
KEY = ["doc", "tie"]


def hasher():
    """anchors(bytes, valid): arrays of first window, windows, gram hash and content hash of each unit."""
    length, gram = LENGTH, GRAM
    spread = length - gram + 1
    a, b, c = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

    def mixed(x):
        x = x * b
        x ^= x >> np.uint64(29)
        x *= c
        return x ^ (x >> np.uint64(32))

    def anchors(text, valid):
        one = mixed(text.astype(np.uint64) + a)
        levels = {1: one}
        for n in (1, 2, 4, 8, 16, 32):
            h = levels[n]
            levels[2 * n] = mixed(h[:-n] * a + h[n:])
            if n not in (8, 32):
                del levels[n]
        h8, h32, h64 = levels[8], levels[32], levels[64]
        size = len(text) - gram + 1
        grams = mixed(h32[:size] * a + h8[32 : 32 + size])
        # The leftmost least gram of each window, over windows of twice the width each time.
        least, place, width = grams, np.arange(size, dtype=np.int32), 1
        while width < spread:
            step = min(width, spread - width)
            left = least[:-step] <= least[step:]
            least, place = np.where(left, least[:-step], least[step:]), np.where(left, place[:-step], place[step:])
            width += step
        count = len(valid)
        place = np.where(valid, place[:count], -1)
        first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
        windows = np.diff(np.r_[first, count])
        own = place[first] >= 0
        first, windows = first[own], windows[own]
        stop = first + windows + length - 1
        middle = first + (windows + length - 1 - 64) // 2
        shape = (windows * 128 + place[first] - first).astype(np.uint64)
        content = mixed(mixed(mixed(h64[first] + shape) + h64[middle]) + h64[stop - 64])
        return first, windows, grams[place[first]], content

    return anchors


def units_of(texts: DataFrame, buckets: int) -> DataFrame:
    """Units by bucket of their gram, packed; of copies in one task's rows the later ones come as covered runs."""
    anchors, length, held, most, dtype = hasher(), LENGTH, WINDOWS_HELD, UNITS_HELD, UNIT

    def packed(units):
        units = units[np.lexsort((units["start"], units["tie"], units["doc"], units["content"], units["fp"]))]
        later = np.r_[False, (units["fp"][1:] == units["fp"][:-1]) & (units["content"][1:] == units["content"][:-1])]
        # Covered runs only pass through, so they go by document.
        to = np.where(later, units["doc"].view(np.uint64), units["fp"]) % np.uint64(buckets)
        order = np.lexsort((later, to))
        units, later, to = units[order], later[order], to[order]
        cuts = np.flatnonzero(np.r_[True, (to[1:] != to[:-1]) | (later[1:] != later[:-1])])
        ends = np.r_[cuts[1:], len(units)]
        return pd.DataFrame(
            {
                "bucket": to[cuts].astype(np.int32),
                "covered": later[cuts],
                "units": [units[i:j].tobytes() for i, j in zip(cuts, ends)],
            }
        )

    def cut(frames):
        kept, count = [], 0
        for frame in frames:
            sizes = frame["bytes"].map(len).to_numpy()
            long = sizes >= length
            frame, sizes = frame[long], sizes[long]
            if not len(frame):
                continue
            text = np.frombuffer(b"".join(frame["bytes"]), np.uint8)
            begins = np.r_[0, np.cumsum(sizes)]
            docs, ties = frame["doc"].to_numpy(np.int64), frame["tie"].to_numpy(np.int64)
            for at in range(0, len(text) - length + 1, held):
                piece = text[at : at + held + length - 1]
                windows = np.arange(at, at + len(piece) - length + 1)
                of = np.searchsorted(begins, windows, "right") - 1
                first, n, fp, content = anchors(piece, windows + length <= begins[of + 1])
                found = np.empty(len(first), dtype)
                row = of[first]
                found["fp"], found["content"], found["doc"], found["tie"] = fp, content, docs[row], ties[row]
                found["start"], found["size"] = at + first - begins[row], n
                kept.append(found)
                count += len(found)
                if count > most:
                    yield packed(np.concatenate(kept))
                    kept, count = [], 0
        if count:
            yield packed(np.concatenate(kept))

    return texts.mapInPandas(cut, "bucket int, covered boolean, units binary")


def sorted_out(packed: DataFrame) -> DataFrame:
    """(doc, tie, start, size, fp): the first of equal units with fp where another unit has its gram; the others as covered."""
    dtype = UNIT

    def resolve(frame):
        covered = frame["covered"].to_numpy(bool)
        runs = np.frombuffer(b"".join(frame["units"][covered]), dtype)
        units = np.frombuffer(b"".join(frame["units"][~covered]), dtype)
        units = units[np.lexsort((units["start"], units["tie"], units["doc"], units["content"], units["fp"]))]
        same_gram = units["fp"][1:] == units["fp"][:-1]
        later = np.r_[False, same_gram & (units["content"][1:] == units["content"][:-1])] if len(units) else np.zeros(0, bool)
        firsts = units[~later]
        new = np.r_[True, firsts["fp"][1:] != firsts["fp"][:-1]] if len(firsts) else np.zeros(0, bool)
        group = np.cumsum(new) - 1
        several = np.bincount(group)[group] > 1 if len(firsts) else new
        out = np.concatenate([runs, units[later], firsts[several]])
        result = pd.DataFrame({n: out[n].astype(np.int64) for n in ("doc", "tie", "start", "size")})
        result["fp"] = pd.array(out["fp"].view("<i8") if out["fp"].flags.c_contiguous else out["fp"].copy().view("<i8"), "Int64")
        result.loc[: len(runs) + later.sum() - 1, "fp"] = pd.NA
        return result

    return packed.groupBy("bucket").applyInPandas(resolve, "doc long, tie long, start long, size long, fp long")


def dense(keys):
    return np.unique(keys, return_inverse=True)[1].astype(np.int64)


def suffix_order(symbols, cover, length):
    """Places in the order of their suffixes, by length bytes at least; a symbol stands for cover bytes and is 1 or more."""
    n = len(symbols)
    if cover >= length or n < 3:
        return np.argsort(symbols, kind="stable") if cover >= length else np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), int)
    s = np.r_[symbols, 0, 0, 0]
    most = int(s.max()) + 1
    one, two = np.arange(1, n, 3), np.arange(2, n, 3)
    sampled = np.r_[one, two]
    names = dense(dense(s[sampled] * most + s[sampled + 1]) * most + s[sampled + 2]) + 1
    if names.max() < len(sampled):
        # Names of either class in a row, with a 0 between them that ends the first.
        between = np.r_[names[: len(one)] + 1, 1, names[len(one) :] + 1]
        order = suffix_order(between, cover * 3, length)
        order = order[order != len(one)]
        by_rank = np.r_[one, -1, two][order]
    else:
        by_rank = sampled[np.argsort(names)]
    rank = np.zeros(n + 3, np.int64)
    rank[by_rank] = np.arange(1, len(by_rank) + 1)
    ranks = len(by_rank) + 1
    zero = np.arange(0, n, 3)
    after_one = s[:-1] * ranks + rank[1:]
    zero = zero[np.argsort(after_one[zero], kind="stable")]
    pair = dense(s[:-1] * most + s[1:])
    after_two = pair[:-1] * ranks + rank[2:]
    # Binary search of each remaining suffix among the sampled ones: compared by the next place that is sampled for both.
    low, high = np.zeros(len(zero), np.int64), np.full(len(zero), len(by_rank), np.int64)
    while (low < high).any():
        middle = (low + high) // 2
        at = by_rank[np.minimum(middle, len(by_rank) - 1)]
        less = np.where(at % 3 == 1, after_one[at] < after_one[zero], after_two[at] < after_two[zero])
        open_ = low < high
        low, high = np.where(open_ & less, middle + 1, low), np.where(open_ & ~less, middle, high)
    order = np.empty(n, np.int64)
    # Among suffixes equal for length bytes the search may end anywhere.
    places = np.maximum.accumulate(low) + np.arange(len(zero))
    order[places] = zero
    rest = np.ones(n, bool)
    rest[places] = False
    order[rest] = by_rank
    return order


def covered_windows(text, starts):
    """For sorted starts of strings in text: the place of the earliest equal string, by comparing neighbours in suffix order."""
    length = LENGTH
    order = suffix_order(text.astype(np.int64) + 1, 1, length)
    wanted = np.zeros(len(text), bool)
    wanted[starts] = True
    order = order[wanted[order]]
    strings = np.lib.stride_tricks.sliding_window_view(text, length)
    new = np.ones(len(order), bool)
    for i in range(1, len(order), 1 << 17):
        j = min(len(order), i + (1 << 17))
        new[i:j] = (strings[order[i:j]] != strings[order[i - 1 : j - 1]]).any(axis=1)
    heads = np.flatnonzero(new)
    earliest = np.zeros(len(text), np.int64)
    if len(order):
        earliest[order] = np.repeat(np.minimum.reduceat(order, heads), np.diff(np.r_[heads, len(order)]))
    return earliest[starts]


def sorted_units(pieces: DataFrame) -> DataFrame:
    """Covered runs of units, and for units that were dealt out the earliest of their equal strings, by hash."""
    length, covered = LENGTH, covered_windows
    out = ["doc", "tie", "start", "size", "left", "right"]

    def work(frame):
        frame = frame.sort_values(["doc", "tie", "start"])
        sizes = frame["piece"].map(len).to_numpy()
        text = np.frombuffer(b"".join(frame["piece"]), np.uint8)
        begins = np.cumsum(sizes) - sizes
        row = np.repeat(np.arange(len(sizes)), sizes - length + 1)
        starts = np.concatenate([np.arange(b, b + n - length + 1) for b, n in zip(begins, sizes)])
        earliest = covered(text, starts)
        later = earliest < starts
        run = np.flatnonzero(later & np.r_[True, ~later[:-1] | (starts[1:] != starts[:-1] + 1)])
        stop = np.flatnonzero(later & np.r_[~later[1:] | (starts[1:] != starts[:-1] + 1), True])
        doc, tie = frame["doc"].to_numpy(), frame["tie"].to_numpy()
        origin = frame["start"].to_numpy() - begins
        found = pd.DataFrame(
            {"doc": doc[row[run]], "tie": tie[row[run]], "start": starts[run] + origin[row[run]], "size": starts[stop] - starts[run] + 1}
        )
        found["left"] = found["right"] = pd.NA
        if frame["salted"].iloc[0]:
            keep = np.flatnonzero(~later)
            digests = b"".join(hashlib.blake2b(text[s : s + length].tobytes(), digest_size=16).digest() for s in starts[keep])
            hashes = np.frombuffer(digests, "<i8").reshape(-1, 2)
            left = pd.DataFrame(
                {"doc": doc[row[keep]], "tie": tie[row[keep]], "start": starts[keep] + origin[row[keep]], "size": 1, "left": hashes[:, 0], "right": hashes[:, 1]}  # noqa: E501
            )
            found = pd.concat([found, left])
        return found[out].astype({"left": "Int64", "right": "Int64"})

    return pieces.groupBy("salted", "bucket").applyInPandas(work, "doc long, tie long, start long, size long, left long, right long")


def keyed(documents: DataFrame) -> tuple[DataFrame, bool]:
    """Different documents with doc, tie, bytes and how many rows each stands for, and whether doc_ids repeat."""
    ids = documents.groupBy("doc_id").count()
    repeated = not ids.where("count > 1").isEmpty()
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("bytes"))
    if repeated:
        texts = texts.groupBy("doc_id", "bytes").agg(F.count("*").alias("copies"))
    else:
        texts = texts.withColumn("copies", F.lit(1).cast("long"))
    tie = F.crc32("bytes") if repeated else F.lit(0).cast("long")
    return texts.withColumn("doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))).withColumn("tie", tie), repeated


def repeated_runs(texts: DataFrame) -> DataFrame:
    """(doc, tie, start, size): runs of covered strings, by first and number of strings."""
    spark = texts.sparkSession
    small_batches(spark)
    total = texts.agg(F.sum(F.length("bytes"))).first()[0] or 0
    buckets = max(8, int(total / ((LENGTH - GRAM) / 2) / UNITS_A_BUCKET))
    found = stored(sorted_out(units_of(texts.select("doc", "tie", "bytes"), buckets)), "suffix-units")
    units = found.where("fp IS NOT NULL")
    counts = units.groupBy("fp").count()
    total_units, most = counts.agg(F.sum("count"), F.max("count")).first()
    tasks = max(spark.sparkContext.defaultParallelism, (total_units or 0) // UNITS_A_TASK + 1)
    if (most or 0) > UNITS_SORTED:
        # The list of such grams is as long as the units allow: a join, not a broadcast.
        many = counts.where(F.col("count") > UNITS_SORTED).select("fp", F.ceil(F.col("count") / UNITS_SORTED).alias("salts"))
        units = units.join(many, "fp", "left")
    else:
        units = units.withColumn("salts", F.lit(None).cast("long"))
    salted = F.col("salts").isNotNull()
    salt = F.when(salted, F.pmod(F.xxhash64("doc", "tie", "start"), F.col("salts"))).otherwise(0)
    dealt = units.withColumn("bucket", F.pmod(F.xxhash64("fp", salt), F.lit(tasks))).withColumn("salted", salted)
    piece = F.substring("bytes", F.col("start").cast("int") + 1, F.col("size").cast("int") + LENGTH - 1)
    pieces = dealt.join(texts.select(*KEY, "bytes"), KEY).select("bucket", "salted", *KEY, "start", piece.alias("piece"))
    sorted_ = stored(sorted_units(pieces), "suffix-runs")
    columns = [*KEY, "start", "size"]
    runs = found.where("fp IS NULL").select(columns).unionByName(sorted_.where("left IS NULL").select(columns))
    if (most or 0) > UNITS_SORTED:
        strings = sorted_.where("left IS NOT NULL")
        at = F.struct(*KEY, "start")
        first = strings.groupBy("left", "right").agg(F.min(at).alias("first"))
        runs = runs.unionByName(strings.join(first, ["left", "right"]).where(at > F.col("first")).select(columns))
    return runs


def without_repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; kept are the bytes that are left."""
    texts, _ = keyed(documents)
    runs = repeated_runs(texts).groupBy(*KEY).agg(F.collect_list(F.struct("start", "size")).alias("runs"))
    kind, length = documents.schema["doc_id"].dataType.simpleString(), LENGTH
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]

    def remove(frames):
        for frame in frames:
            rows = []
            for doc_id, data, runs, copies in zip(frame["doc_id"], frame["bytes"], frame["runs"], frame["copies"]):
                doc_id = None if pd.isna(doc_id) else doc_id
                n = len(data)
                spans = sorted((r["start"], r["start"] + r["size"] + length - 1) for r in runs) if runs is not None else []
                kept, end, removed, count = [], 0, 0, 0
                for a, b in spans:
                    if a > end or count == 0:
                        kept.append(data[end:a])
                        count += 1
                        removed += b - a
                        end = b
                    elif b > end:
                        removed += b - end
                        end = b
                rows.append((doc_id, n, removed, count, b"".join([*kept, data[end:]])))
                # Equal rows come after the first one, which covers them whole.
                gone = n >= length
                rows += [(doc_id, n, n if gone else 0, int(gone), b"" if gone else data)] * (copies - 1)
            yield pd.DataFrame(rows, columns=names)

    joined = texts.join(runs, KEY, "left").select(F.col("doc_id").cast("string").alias("doc_id"), "bytes", "runs", "copies")
    found = joined.mapInPandas(remove, "doc_id string, n_bytes long, n_removed long, n_spans long, kept binary")
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))
