"""Equi-joins whose big side has very frequent keys.

A key with more rows than one task should hold is hot. Its rows are spread over several salts and
the other side's row is repeated once per salt. The result equals the plain join; without hot keys
it is the plain join. The list of hot keys is counted first and is broadcast while it is short.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.session import cut_lineage

# Rows of one key that one task should hold.
MIN_ROWS = 200_000
# The list is sent to all tasks up to so many keys and joined by a shuffle beyond.
BROADCAST_KEYS = 10_000

SALT = "_salt"
SPLITS = "_splits"


@dataclass(frozen=True)
class HotKeys:
    """Split counts of the hot keys of one column; `splits` is None when there are none."""

    key: str
    splits: DataFrame | None

    @property
    def join_columns(self) -> list[str]:
        return [self.key] if self.splits is None else [self.key, SALT]

    def spread(self, big: DataFrame, spread_by: list[str]) -> DataFrame:
        """Number the rows of a hot key 0..splits-1 by a hash of spread_by; others get 0."""
        if self.splits is None:
            return big
        salt = F.when(
            F.col(SPLITS).isNotNull(), F.pmod(F.xxhash64(*spread_by), F.col(SPLITS)).cast("int")
        ).otherwise(F.lit(0))
        joined = big.join(self.splits, self.key, "left")
        return joined.withColumn(SALT, salt).drop(SPLITS)

    def repeat(self, small: DataFrame) -> DataFrame:
        """One copy of each row per salt of its key."""
        if self.splits is None:
            return small
        salts = F.sequence(F.lit(0), F.coalesce(F.col(SPLITS), F.lit(1)) - 1)
        joined = small.join(self.splits, self.key, "left")
        return joined.withColumn(SALT, F.explode(salts)).drop(SPLITS)


def find_hot_keys(df: DataFrame, key: str, min_rows: int = MIN_ROWS) -> HotKeys:
    """Keys with more than min_rows rows. One pass with map-side counts; the list stays in storage."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    parts = F.ceil(F.col("_rows") / F.lit(float(max(min_rows, 1)))).cast("int").alias(SPLITS)
    found = cut_lineage(counts.filter(F.col("_rows") > min_rows).select(key, parts))
    size = found.count()
    if not size:
        return HotKeys(key, None)
    return HotKeys(key, F.broadcast(found) if size <= BROADCAST_KEYS else found)


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    spread_by: list[str],
    min_rows: int = MIN_ROWS,
) -> DataFrame:
    """Inner join of big and small on key; spread_by are columns of big that vary within a key."""
    hot = find_hot_keys(big.select(key), key, min_rows)
    joined = hot.spread(big, spread_by).join(hot.repeat(small), hot.join_columns)
    return joined.drop(SALT)
