"""Column expressions shared by the operators that run without Python."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.llm.common import WORD_BREAK

SHINGLE_WORDS = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once; a plain reference in a lambda would be worked out for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Runs of anything but the white space bytes; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def window_hashes(words: Column, size: int = SHINGLE_WORDS) -> Column:
    """A 64-bit hash of every window of so many words, in order; empty for fewer words."""

    def windows(hashes):
        return F.transform(
            F.sequence(F.lit(0), F.size(hashes) - size),
            lambda k: F.xxhash64(*(F.get(hashes, k + j) for j in range(size))),
        )

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    none = F.array().cast("array<bigint>")
    return let(hashed, lambda h: F.when(F.size(h) < size, none).otherwise(windows(h)))
