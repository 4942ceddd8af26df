"""One-permutation MinHash fingerprints with optimal densification, in DataFrame functions only."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.native import SHINGLE_WORDS, let, window_hashes, words

BIN_BITS = 7
BINS = 1 << BIN_BITS
LOW_BITS = 8
PROBES = 4
# Factors of the order in which an empty bin asks the others.
ORDER = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, (1 << 31) - 1)


def place_in_order(bin: int, other: int) -> int:
    """Where bin ranks the other one: a fixed pseudo-random number, the same in Python and in SQL."""
    a, b, c, prime = ORDER
    x = (bin * a + other * b + 1) % prime
    return (x * x % prime) * c % prime * 256 + other


def place_in_order_column(bin: Column, other: Column) -> Column:
    a, b, c, prime = (F.lit(k).cast("bigint") for k in ORDER)
    x = (bin.cast("bigint") * a + other.cast("bigint") * b + 1) % prime
    # The last product stays under 2^63: both factors are under 2^32.
    return (x * x % prime) * c % prime * 256 + other


def shingles(text: Column) -> Column:
    """Hashes of all runs of five words; of the whole sequence for fewer words, none for no word."""
    return let(
        words(text),
        lambda w: F.when(F.size(w) >= SHINGLE_WORDS, window_hashes(w))
        .when(F.size(w) > 0, F.array(F.xxhash64(F.concat_ws(" ", w))))
        .otherwise(F.array().cast("array<bigint>")),
    )


def bins(hashes: Column) -> Column:
    """The least value of every bin in bin order, null where a bin got no hash.

    The top bits of a hash name the bin and the others are its value. One made-up hash at the end of each bin, sorted
    in with the real ones, leaves exactly one first element for each bin.
    """
    shift = 63 - BIN_BITS
    ends = [((k + 1) << shift) - 1 for k in range(BINS)]
    positive = F.transform(hashes, lambda h: F.shiftrightunsigned(h, 1))
    ordered = F.sort_array(F.concat(positive, F.array(*map(F.lit, ends)).cast("array<bigint>")))

    def first_of_bin(all):
        first = F.filter(
            all, lambda h, k: (k == 0) | (F.shiftright(F.get(all, k - 1), shift) != F.shiftright(h, shift))
        )
        low = F.lit((1 << shift) - 1).cast("bigint")
        return F.transform(first, lambda h: F.when(h.bitwiseAND(low) != low, h.bitwiseAND(low)))

    return let(ordered, first_of_bin)


def densified(values: Column) -> Column:
    """Values of all bins, an empty one taking that of the first non-empty bin in its own order; null if all are empty."""
    probes = [
        [sorted(range(BINS), key=lambda other: place_in_order(bin, other))[k] for bin in range(BINS)] for k in range(PROBES)
    ]

    def search(bin, filled):
        ordered = F.transform(filled, lambda x: F.struct(place_in_order_column(bin, x["bin"]), x["value"].alias("value")))
        return F.array_min(ordered)["value"]

    def fill(v):
        filled = F.filter(F.transform(v, lambda x, k: F.struct(k.alias("bin"), x.alias("value"))), lambda x: x["value"].isNotNull())
        # The first probes answer for nearly all bins of long texts; for short ones few bins are left to search.
        tables = [F.array(*map(F.lit, probe)) for probe in probes]
        return let(
            filled,
            lambda own: F.transform(
                v,
                lambda x, bin: F.coalesce(x, *(F.get(v, F.get(t, bin)) for t in tables), search(bin, own)),
            ),
        )

    return let(values, lambda v: F.when(F.exists(v, lambda x: x.isNotNull()), fill(v)))


def fingerprint(text: Column) -> Column:
    """The low bits of all bins as hexadecimal text, two letters a bin; the empty text for no word."""
    digits = F.array(*(F.lit(f"{k:02x}") for k in range(1 << LOW_BITS)))
    packed = let(
        digits,
        lambda d: F.array_join(
            F.transform(densified(bins(shingles(text))), lambda x: F.get(d, x.bitwiseAND(F.lit((1 << LOW_BITS) - 1)).cast("int"))), ""
        ),
    )
    return F.coalesce(packed, F.lit(""))


def likeness(one: Column, other: Column) -> Column:
    """Estimated Jaccard similarity: the share of equal bins, less the share that is equal by chance.

    1 for two fingerprints of no word, 0 for one such.
    """
    chance = 1 / (1 << LOW_BITS)
    width = LOW_BITS // 4
    pairs = F.sequence(F.lit(0), F.lit(BINS - 1))
    equal = F.size(
        F.filter(pairs, lambda k: F.substr(one, k * width + 1, F.lit(width)) == F.substr(other, k * width + 1, F.lit(width)))
    )
    estimate = F.greatest((equal / BINS - chance) / (1 - chance), F.lit(0.0))
    return F.when((one == "") | (other == ""), (one == other).cast("double")).otherwise(estimate)


def range_ends(docs: DataFrame, ranges: int) -> list[int]:
    """Quantiles of doc_id that part the rows into so many ranges, at most."""
    quantiles = F.percentile_approx("doc_id", [k / ranges for k in range(1, ranges)], 20 * ranges)
    return sorted(set(docs.agg(quantiles.alias("ends")).first().ends or [])) if ranges > 1 else []


def range_of(key: Column, ends: list[int]) -> Column:
    """How many ends are not above key; 0 for null.

    The list is cut into pieces, as a long one would be searched through for every row.
    """
    if not ends:
        return F.lit(0)
    size = int(len(ends) ** 0.5)
    pieces = [F.array(*(F.lit(e).cast("bigint") for e in ends[k : k + size])) for k in range(0, len(ends), size)]
    firsts = F.array(*(F.lit(e).cast("bigint") for e in ends[::size]))
    not_above = lambda list: F.size(F.filter(list, lambda end: end <= key))
    inside = lambda piece: piece * size + not_above(F.get(F.array(*pieces), piece))
    found = let(not_above(firsts), lambda n: F.when(n == 0, F.lit(0)).otherwise(inside(n - 1)))
    return F.when(key.isNull(), F.lit(0)).otherwise(found)


def beside_next(docs: DataFrame, carried: list[str]) -> DataFrame:
    """doc_id, the carried columns, and each of them as next_* from the next row by doc_id; the first follows the last.

    Rows are dealt out by ranges of doc_id between quantiles, four a shuffle partition, so no window holds the whole
    table. The first row of a range also visits the range in front of it, or the last one if there is none, where it
    stands at the end. Null doc_id comes first; rows of one doc_id follow each other by their carried columns.
    """
    spark = docs.sparkSession
    ends = range_ends(docs, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = docs.select("doc_id", range_of(F.col("doc_id"), ends).alias("range"), *carried)
    # One row for each range comes to the driver: the first doc_id there, and whether null is.
    starts = placed.groupBy("range").agg(F.min("doc_id"), F.max(F.col("doc_id").isNull()), F.min("range")).collect()
    starts = sorted(tuple(r)[:3] for r in starts)
    first_ids, before = [None] * (len(ends) + 1), [0] * (len(ends) + 1)
    for k, (at, first, has_null) in enumerate(starts):
        first_ids[at], before[at] = None if has_null else first, starts[k - 1][0]
    literal = lambda values, kind: F.array(*(F.lit(v).cast(kind) for v in values))
    is_first = F.col("doc_id").eqNullSafe(F.get(literal(first_ids, "bigint"), F.col("range")))
    home = F.struct(F.col("range").alias("at"), F.lit(0).alias("visitor"))
    visit = F.struct(F.get(literal(before, "int"), F.col("range")).alias("at"), F.lit(1).alias("visitor"))
    places = F.when(is_first, F.array(home, visit)).otherwise(F.array(home))
    rows = placed.select("doc_id", *carried, F.explode(places).alias("place"))
    rows = rows.select("doc_id", *carried, "place.at", "place.visitor")
    following = Window.partitionBy("at").orderBy("visitor", F.col("doc_id").asc_nulls_first(), *carried)
    nexts = [F.lead(name).over(following).alias(f"next_{name}") for name in carried]
    return rows.select("doc_id", "visitor", *carried, *nexts).where("visitor = 0").drop("visitor")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next for every document.

    edited is the text with its last floor(n_chars / 2) code points replaced by the first as many (or all) of the next
    document's. Null and empty texts have an empty fingerprint and are left as they are by the edit; equal texts have
    equal fingerprints; rows are all kept; an empty table gives no rows. Other columns are left out.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    rows = beside_next(texts.withColumn("fingerprint", fingerprint(F.col("text"))), ["text", "fingerprint"])
    size = F.length("text")
    half = F.expr("length(text) div 2").cast("int")
    edited = F.concat(F.substr("text", F.lit(1), size - half), F.substr("next_text", F.lit(1), half))
    rows = rows.withColumn("n_chars", size.cast("bigint")).withColumn("edited", edited)
    rows = rows.withColumn("edited_fingerprint", fingerprint(F.col("edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
