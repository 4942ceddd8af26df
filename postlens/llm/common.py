"""Shared parts: written intermediate tables, state kept by Python workers, ranks without one big window."""

import gc
import sys
import types

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.session import fresh_path

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
# Words are runs of anything but these bytes.
WORD_BREAK = "[\\x20\\x09-\\x0D]+"
ROWS_PER_RANK_GROUP = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and go on from the written table."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def per_worker(key, make):
    """make() once for each Python worker and kind of work.

    Functions are sent by value, so their globals are new for every task; workers are reused, and a
    module of the worker outlives the task. One thing is kept at a time: what another job left goes,
    with the memory of its batches, which Arrow's pool would hold on to.
    """
    kept = sys.modules.setdefault("_postlens_llm_kept", types.ModuleType("_postlens_llm_kept"))
    if getattr(kept, "key", None) != key:
        kept.key = kept.value = None
        gc.collect()
        pa.default_memory_pool().release_unused()
        kept.value = make()
        kept.key = key
    return kept.value


def held_out(doc_id: Column) -> Column:
    """True for the third of documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")), F.lit(0)) % 3 == 1


def thinned(df: DataFrame, rows: int, by: str | None = None) -> DataFrame:
    """Rows whose hashed doc_id is under a bound that leaves half as much again as rows, for each value of by.

    An exact choice of the first `rows` by hash then reads few rows, where it would gather as many from every task. by
    has few values (labels, languages): their counts come to the driver.
    """
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31))
    bound = lambda n: int(min(1.0, 1.5 * rows / max(n, 1)) * (1 << 31))
    if by is None:
        return df.where(hashed < F.lit(bound(df.count())))
    counts = df.groupBy(by).agg(F.count("*").alias("n")).collect()
    bounds = F.create_map(*(F.lit(x) for r in counts for x in (r[by], bound(r.n)))) if counts else F.create_map()
    return df.where(hashed < bounds[F.col(by)]) if counts else df


def ranked(df: DataFrame, keys: list[str], order: list[str], rank: str = "rank") -> DataFrame:
    """Add a gapless rank from 0 within keys, in no particular order across groups of rows.

    A key may hold most rows, so rows are ranked within (keys, salt) and shifted by the rows of the
    smaller salts; the salt comes from the order columns. df must be stored: it is read twice.
    """
    salts = 64 + df.count() // ROWS_PER_RANK_GROUP
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)))
    before = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        salted.groupBy(*keys, "_salt")
        .agg(F.count("*").alias("_n"))
        .withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    own = Window.partitionBy(*keys, "_salt").orderBy(*order)
    numbered = salted.withColumn("_own", F.row_number().over(own) - 1)
    return (
        numbered.join(shift, [*keys, "_salt"])
        .withColumn(rank, F.col("_own") + F.col("_shift"))
        .drop("_own", "_shift", "_salt")
    )
