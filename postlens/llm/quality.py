"""Quality scores from compressed sizes under a dictionary of good and one of bad text."""

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import held_out, per_worker, stored, thinned

# The classifier is fitted on so many texts of each class, those with the smallest hashed doc_id; half of them
# make the dictionaries, with so many blocks of each text, and the other half the calibration.
SAMPLE_TEXTS = 4000
SAMPLE_BLOCKS = 32
BLOCK_BYTES = 1024
DICTIONARY_BYTES = 112 << 10
LEVEL = 3
NEWTON_STEPS = 50


def blocks_of(text: str | None) -> list[bytes]:
    body = (text or "").encode("utf-8")
    return [body[start : start + BLOCK_BYTES] for start in range(0, len(body), BLOCK_BYTES)]


class SizeDifference:
    """(size under the bad dictionary - size under the good one) / bytes, 0 for no text.

    Texts are compressed in blocks, each against the dictionaries alone: over a long text a compressor
    would learn the text itself and the dictionaries would no longer matter.
    """

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = self.compressor(good), self.compressor(bad)

    @staticmethod
    def compressor(content):
        dictionary = zstandard.ZstdCompressionDict(content)
        dictionary.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(
            level=LEVEL, dict_data=dictionary, write_content_size=False, write_dict_id=False
        ).compress

    def __call__(self, text):
        blocks = blocks_of(text)
        more = sum(len(self.bad(b)) - len(self.good(b)) for b in blocks)
        return more / max(1, sum(map(len, blocks)))


class Classifier:
    """Dictionaries and the calibration: P(good) = 1 / (1 + exp(-(slope * difference + shift)))."""

    def __init__(self, good: bytes = b"", bad: bytes = b"", slope: float = 0.0, shift: float = 0.0):
        self.good, self.bad, self.slope, self.shift = good, bad, slope, shift

    def differences(self, texts):
        if not self.good or not self.bad:
            return np.zeros(len(texts))
        measure = per_worker(("size difference", hash((self.good, self.bad))), lambda: SizeDifference(self.good, self.bad))
        return np.array([measure(text) for text in texts])

    def __call__(self, texts):
        return 1 / (1 + np.exp(-np.clip(self.slope * self.differences(texts) + self.shift, -500, 500)))


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton's method, with a weak pull to a slope of 0 and targets off 0 and 1 (Platt)."""
    ones, zeros = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    scale = x.std() or 1.0
    features = np.stack([x / scale, np.ones_like(x)], axis=1)
    weights = np.zeros(2)
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-features @ weights))
        gradient = features.T @ (p - target) + np.array([1e-3, 0]) * weights
        hessian = (features * (p * (1 - p))[:, None]).T @ features + np.diag([1e-3, 1e-9])
        step = np.linalg.solve(hessian, gradient)
        weights = weights - step
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0] / scale), float(weights[1])


def fit_classifier(docs: DataFrame, labels: DataFrame) -> Classifier:
    """Learn from labelled documents outside the held-out third.

    The sample is bounded (SAMPLE_TEXTS a class, SAMPLE_BLOCKS a text), so the driver holds as much
    whatever the tables' size. Null labels and labels of unknown documents are left out; without texts of both classes
    every score is 0.5.
    """
    by_hash = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    known = labels.select("doc_id", F.col("quality").cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))
    )
    chosen = (
        thinned(known, SAMPLE_TEXTS, "label")
        .dropDuplicates()
        .withColumn("place", F.row_number().over(by_hash))
        .where(F.col("place") <= SAMPLE_TEXTS)
    )
    texts = docs.select("doc_id", "text").where(~held_out(F.col("doc_id")))
    # At most two classes of SAMPLE_TEXTS rows are sent to all tasks.
    sample = stored(texts.join(F.broadcast(chosen), "doc_id"), "quality-sample")

    def cut(batches):
        for batch in batches:
            rows = [
                (label.as_py(), block)
                for text, label in zip(batch.column("text"), batch.column("label"))
                for block in blocks_of(text.as_py())[:SAMPLE_BLOCKS]
            ]
            columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["label", "block"])

    fitting = sample.where("place % 2 = 0").select("text", F.col("label").cast("int").alias("label"))
    blocks = fitting.mapInArrow(cut, "label int, block binary").collect()
    contents = [dictionary_of([bytes(r.block) for r in blocks if r.label == label]) for label in (1, 0)]
    classifier = Classifier(*contents)

    @F.pandas_udf("double")
    def difference(texts: pd.Series) -> pd.Series:
        return pd.Series(classifier.differences(texts))

    rows = sample.where("place % 2 = 1").select(difference("text").alias("x"), "label").collect()
    y = np.array([r.label for r in rows])
    if all(contents) and 0 < y.sum() < len(y):
        classifier.slope, classifier.shift = logistic(np.array([r.x for r in rows]), y)
    return classifier


def dictionary_of(blocks: list[bytes]) -> bytes:
    """A trained dictionary; the blocks themselves where they are too few to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sorted(blocks)).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sorted(blocks))[-DICTIONARY_BYTES:]


def quality_score(classifier: Classifier) -> Column:
    """The score of the column `text`: 0 to 1, the chance of label 1. Null and empty texts have a difference of 0."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(classifier(texts))

    return score("text")
