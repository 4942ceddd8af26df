"""All aspect heads trained together: one softmax per head over shared hashed TF-IDF features, one pass of the data per step.

Documents are packed into blocks of sparse index arrays once. In a step every task sums the gradients of all heads over its
blocks, the sums meet by slice of the features, and the driver takes one limited-memory quasi-Newton step on arrays
whose size is features x heads x classes, whatever the number of documents.
"""

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions.text import tokens
from postlens.session import small_batches, spread

BLOCK_ROWS = 2048
SLICES = 16
MEMORY = 10
# Length of a text's vector: with it weights and biases change at about the same pace, so that few steps are enough.
LENGTH = 8.0
# Margin of a class that a head has not seen.
NEVER = -1e9


def buckets(text: Column, features: int) -> Column:
    """Hashed word of each place of the text."""
    return F.transform(tokens(text), lambda w: F.pmod(F.xxhash64(w), F.lit(features)).cast("int"))


def vectors(lists, idf):
    """(row, bucket, value) of equally long TF-IDF vectors, sorted by row and bucket."""
    sizes = np.array([0 if x is None else len(x) for x in lists], np.int64)
    features = len(idf)
    flat = np.concatenate([np.zeros(0, np.int64), *(np.asarray(x, np.int64) for x in lists if x is not None and len(x))])
    keys, counts = np.unique(np.repeat(np.arange(len(sizes)), sizes) * features + flat, return_counts=True)
    row, bucket = keys // features, keys % features
    value = counts * idf[bucket]
    norm = np.sqrt(np.bincount(row, value * value, len(sizes)))
    return row, bucket, LENGTH * value / np.where(norm > 0, norm, 1)[row]


def margins(rows, row, bucket, value, weights, bias):
    """rows x margins; a text without words has the bias alone."""
    out = np.tile(bias, (rows, 1))
    if len(row):
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[first]] += np.add.reduceat(weights[bucket] * value[:, None], first, axis=0)
    return out


def softmax(scores, classes):
    """Probabilities of each head's classes side by side."""
    shaped = scores.reshape(len(scores), -1, classes)
    e = np.exp(shaped - shaped.max(axis=2, keepdims=True))
    return e / e.sum(axis=2, keepdims=True)


@dataclass
class Heads:
    """Weights of all heads: features x (heads * classes). trained: whether a head saw two classes; missing: those it did not see."""

    names: list[str]
    classes: int
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trained: dict[str, bool]
    missing: dict[str, list[int]]
    iterations: int
    converged: bool
    loss: float

    def probabilities(self, spark: SparkSession, text: Column) -> Column:
        """Probabilities of all heads side by side, in one Arrow function.

        It is marked as not deterministic, so that the planner never copies it, with the cleaning of the text below it, into a
        filter that it makes from an explode or a condition on the results: each text is cleaned and scored once.
        """
        small_batches(spark)
        model = spark.sparkContext.broadcast((self.idf, self.weights, self.bias))
        classes = self.classes

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def score(lists: pd.Series) -> pd.Series:
            idf, weights, bias = model.value
            found = softmax(margins(len(lists), *vectors(lists, idf), weights, bias), classes)
            return pd.Series(list(found.reshape(len(lists), -1)), index=lists.index)

        return score.asNondeterministic()(buckets(text, len(self.idf)))

    def term_weights(self, terms: DataFrame) -> DataFrame:
        """Weights of each term of `terms` (column term): term, bucket, idf, head, class, weight; what scores it in SQL."""
        hashed = terms.select("term", F.pmod(F.xxhash64("term"), F.lit(len(self.idf))).cast("int").alias("bucket"))
        spark, names = terms.sparkSession, self.names
        model = spark.sparkContext.broadcast((self.idf, self.weights))
        classes = self.classes

        def look_up(frames):
            idf, weights = model.value
            for frame in frames:
                found = weights[frame["bucket"].to_numpy()]
                for k, name in enumerate(names):
                    for c in range(classes):
                        out = frame.assign(idf=idf[frame["bucket"].to_numpy()], head=name, weight=found[:, k * classes + c])
                        out["class"] = c
                        yield out[["term", "bucket", "idf", "head", "class", "weight"]]

        return hashed.mapInPandas(look_up, "term string, bucket int, idf double, head string, class int, weight double")

    def report(self, spark: SparkSession) -> DataFrame:
        """head, trained, missing classes, iterations, converged, loss, bias of each class."""
        rows = [
            (n, self.trained[n], self.missing[n], self.iterations, self.converged, self.loss, self.bias.reshape(-1, self.classes)[k].tolist())
            for k, n in enumerate(self.names)
        ]
        return spark.createDataFrame(
            rows, "head string, trained boolean, missing array<int>, iterations int, converged boolean, loss double, bias array<double>"
        )


def minimised(value_and_gradient, start, max_iter, tolerance):
    """Limited-memory quasi-Newton steps with halved step lengths: (point, value, steps, whether the gradient got small)."""
    x = start
    value, gradient = value_and_gradient(x)
    first = np.abs(gradient).max()
    moves, changes = [], []
    for step in range(1, max_iter + 1):
        if np.abs(gradient).max() <= tolerance * first:
            return x, value, step - 1, True
        direction, saved = -gradient, []
        for s, y in zip(reversed(moves), reversed(changes)):
            a = (s @ direction) / (s @ y)
            direction = direction - a * y
            saved.append(a)
        if moves:
            direction = direction * (moves[-1] @ changes[-1]) / (changes[-1] @ changes[-1])
        else:
            direction = direction / max(1e-12, np.linalg.norm(gradient))
        for s, y, a in zip(moves, changes, reversed(saved)):
            direction = direction + (a - (y @ direction) / (s @ y)) * s
        slope, length = gradient @ direction, 1.0
        while True:
            ahead = x + length * direction
            new_value, new_gradient = value_and_gradient(ahead)
            if new_value <= value + 1e-4 * length * slope or length < 1e-8:
                break
            length /= 2
        if new_value > value:
            return x, value, step, True
        s, y = ahead - x, new_gradient - gradient
        if s @ y > 1e-12:
            moves, changes = [*moves, s][-MEMORY:], [*changes, y][-MEMORY:]
        x, value, gradient = ahead, new_value, new_gradient
    return x, value, max_iter, bool(np.abs(gradient).max() <= tolerance * first)


def fit_heads(
    labelled: DataFrame, text: str, names: list[str], label: dict[str, Column], classes: int,
    features: int, max_iter: int, regularisation: float, tolerance: float, balanced: bool,
) -> Heads:
    """All heads over the rows of labelled; label: column of the class of each head. balanced: classes of a head weigh the same."""
    spark = labelled.sparkSession
    # Blocks and what a step reads at a time then have so many rows and bytes, whatever the rows of a task.
    small_batches(spark)
    ready = spread(labelled).select(buckets(F.col(text), features).alias("_b"), *(label[n].cast("int").alias(n) for n in names)).persist()
    k = len(names)
    seen = ready.agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(F.col(n) == c).alias(f"{n}|{c}") for n in names for c in range(classes))
    ).first()
    total = max(1, seen["n"])
    counts = np.array([[seen[f"{n}|{c}"] for c in range(classes)] for n in names], float)
    met = ready.select(F.explode(F.array_distinct("_b")).alias("b")).groupBy("b").count().collect()
    frequency = np.zeros(features)
    for r in met:
        frequency[r[0]] = r[1]
    idf = np.log((total + 1) / (frequency + 1))
    present = counts > 0
    trained = present.sum(axis=1) >= 2
    share = np.where(present, total / (np.maximum(counts, 1) * np.maximum(present.sum(axis=1, keepdims=True), 1)), 0.0)
    row_weight = share if balanced else np.ones_like(share)
    # Only heads with something to learn take part in the steps.
    learnt = np.flatnonzero(trained)
    never = np.where(present, 0.0, NEVER)[learnt].ravel()
    row_weight = row_weight[learnt]
    learning = [names[i] for i in learnt]
    fixed = spark.sparkContext.broadcast((idf, row_weight, never))

    def pack(frames):
        idf = fixed.value[0]
        for frame in frames:
            for at in range(0, len(frame), BLOCK):
                part = frame.iloc[at : at + BLOCK]
                row, bucket, value = vectors(part["_b"], idf)
                yield pd.DataFrame(
                    {
                        "row": [row.astype(np.int32).tobytes()],
                        "bucket": [bucket.astype(np.int32).tobytes()],
                        "value": [value.tobytes()],
                        "labels": [part[learning].to_numpy(np.int8).tobytes()],
                    }
                )

    BLOCK = BLOCK_ROWS
    blocks = ready.mapInPandas(pack, "row binary, bucket binary, value binary, labels binary").persist()
    width = len(learning) * classes
    edges = np.linspace(0, features, SLICES + 1).astype(int)

    def step(point):
        sent = spark.sparkContext.broadcast(point)

        def sums(frames):
            weights, bias = sent.value[:-width].reshape(features, width), sent.value[-width:]
            _, row_weight, never = fixed.value
            gradient, own, loss = np.zeros((features, width)), np.zeros(width), 0.0
            for frame in frames:
                for r in frame.itertuples(index=False):
                    row, bucket = np.frombuffer(r.row, np.int32), np.frombuffer(r.bucket, np.int32)
                    value, labels = np.frombuffer(r.value), np.frombuffer(r.labels, np.int8).reshape(-1, len(learning))
                    n = len(labels)
                    p = softmax(margins(n, row, bucket, value, weights, bias + never), classes)
                    w = row_weight[np.arange(len(learning)), labels]
                    hit = np.take_along_axis(p, labels[:, :, None].astype(int), 2)[:, :, 0]
                    loss -= (w * np.log(np.maximum(hit, 1e-300))).sum()
                    p[np.arange(n)[:, None], np.arange(len(learning)), labels] -= 1
                    error = (p * w[:, :, None]).reshape(n, width)
                    own += error.sum(axis=0)
                    if len(bucket):
                        order = np.argsort(bucket, kind="stable")
                        b = bucket[order]
                        first = np.flatnonzero(np.r_[True, b[1:] != b[:-1]])
                        gradient[b[first]] += np.add.reduceat(error[row[order]] * value[order][:, None], first, axis=0)
            yield pd.DataFrame(
                {
                    "slice": range(-1, len(edges) - 1),
                    "part": [np.r_[loss, own].tobytes(), *(gradient[i:j].astype(np.float32).tobytes() for i, j in zip(edges, edges[1:]))],
                }
            )

        def added(frame):
            kind = np.float64 if frame["slice"][0] < 0 else np.float32
            total = sum(np.frombuffer(x, kind).astype(np.float64) for x in frame["part"])
            return pd.DataFrame({"slice": frame["slice"][:1], "part": [total.tobytes()]})

        schema = "slice int, part binary"
        parts = blocks.mapInPandas(sums, schema).groupBy("slice").applyInPandas(added, schema).collect()
        sent.destroy()
        if not parts:
            return 0.0, np.zeros_like(point)
        parts = {r[0]: np.frombuffer(r[1]) for r in parts}
        head = parts[-1] / total
        gradient = np.r_[np.concatenate([parts[i] for i in range(SLICES)]) / total, head[1:]]
        gradient[:-width] += regularisation * point[:-width]
        return head[0] + regularisation / 2 * (point[:-width] @ point[:-width]), gradient

    start = np.zeros(features * width + width)
    point, loss, steps, converged = minimised(step, start, max_iter, tolerance) if width else (start, 0.0, 0, True)
    blocks.unpersist()
    ready.unpersist()
    weights, bias = np.zeros((features, k, classes)), np.zeros((k, classes))
    weights[:, learnt] = point[: features * width].reshape(features, -1, classes)
    bias[learnt] = point[features * width :].reshape(-1, classes)
    # A head without two classes names the one it knows, or none more than another.
    bias += np.where(present.any(axis=1, keepdims=True) & ~present, NEVER, 0.0)
    return Heads(
        names, classes, idf, weights.reshape(features, -1), bias.ravel(),
        dict(zip(names, trained.tolist())), {n: np.flatnonzero(~present[i]).tolist() for i, n in enumerate(names)},
        steps, converged, float(loss),
    )
