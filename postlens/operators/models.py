"""Aspect sentiment models: splits, class balance, heads, scoring, evaluation and the gate."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from postlens.functions.numeric import percent, rounded
from postlens.operators.heads import Heads, fit_heads
from postlens.schemas import ASPECTS, LABELS, SCORE_OF_LABEL

NEUTRAL = LABELS.index("neutral")

# A scorer adds the map column `aspects` (schemas.ASPECT_MAP) to a DataFrame with clean_text.
Scorer = Callable[[DataFrame], DataFrame]


def split_bucket(key: Column, buckets: int = 100) -> Column:
    """A number 0..buckets-1 that depends on the key alone, so a rerun splits the same."""
    digest = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.pmod(F.conv(digest, 16, 10).cast("bigint"), F.lit(buckets))


def split_curated(df: DataFrame, key: str, train: int = 80, validation: int = 10) -> DataFrame:
    """Add `split`: train, validation or test, by percent of the key space."""
    bucket = split_bucket(F.col(key))
    return df.withColumn(
        "split",
        F.when(bucket < train, "train")
        .when(bucket < train + validation, "validation")
        .otherwise("test"),
    )


def write_splits(df: DataFrame, key: str, path: str) -> None:
    split_curated(df, key).write.mode("overwrite").partitionBy("split").parquet(path)


def class_balance(labelled: DataFrame, aspects: list[str] = ASPECTS) -> DataFrame:
    """aspect, label, texts, share_pct; an absent label counts as neutral."""
    long = labelled.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(a).alias("aspect"),
                        F.coalesce(F.col("labels")[a], F.lit(NEUTRAL)).alias("label"),
                    )
                    for a in aspects
                ]
            )
        ).alias("x")
    )
    counted = long.groupBy("x.aspect", "x.label").agg(F.count(F.lit(1)).alias("texts"))
    # At most aspects * labels rows.
    share = percent(F.col("texts"), F.sum("texts").over(W.partitionBy("aspect")), 2)
    return counted.withColumn("share_pct", share)


@dataclass
class AspectModel:
    """The trained heads, callable as a scorer."""

    heads: Heads

    def __call__(self, df: DataFrame, text: str = "clean_text") -> DataFrame:
        return score_aspects(df, self, text)


def train_aspect_heads(
    labelled: DataFrame,
    text: str = "clean_text",
    aspects: list[str] = ASPECTS,
    features: int = 1 << 16,
    max_iter: int = 100,
    regularisation: float = 5e-3,
    tolerance: float = 2e-2,
    balanced: bool = True,
) -> AspectModel:
    """One softmax head per aspect over the same hashed TF-IDF features, all in one pass a step.

    labelled: text and `labels`, a map from aspect to 0, 1 or 2; absent means neutral. A head that meets one class alone is
    reported as untrained and names that class. The steps end when the largest gradient is tolerance of the first one.
    """
    label = {a: F.coalesce(F.col("labels")[a], F.lit(NEUTRAL)) for a in aspects}
    return AspectModel(
        fit_heads(labelled, text, aspects, label, len(LABELS), features, max_iter, regularisation, tolerance, balanced)
    )


def aspect_result(probabilities: Column) -> Column:
    """Label, score, confidence and the three probabilities of one aspect.

    The first class wins a tie. A class the head has never seen has probability 0.
    """
    known = F.transform(F.sequence(F.lit(0), F.lit(len(LABELS) - 1)), lambda i: F.coalesce(F.get(probabilities, i), F.lit(0.0)))
    scores = F.array(*[F.lit(SCORE_OF_LABEL[x]) for x in LABELS])

    def result(p):
        at = F.array_position(p, F.array_max(p)).cast("int")
        return F.struct(
            F.element_at(F.array(*[F.lit(x) for x in LABELS]), at).alias("label"),
            F.element_at(scores, at).alias("score"),
            F.round(F.array_max(p), 4).alias("confidence"),
            F.struct(*[F.round(F.get(p, F.lit(i)), 4).alias(x) for i, x in enumerate(LABELS)]).alias("probabilities"),
        )

    # The probabilities get a name, so their expression is not written out at each use.
    return F.get(F.transform(F.array(known), result), F.lit(0))


def score_aspects(df: DataFrame, model: AspectModel, text: str = "clean_text") -> DataFrame:
    """Add `aspects`: a map from aspect to its result. One Arrow function for all heads, then expressions."""
    heads, n = model.heads, len(LABELS)
    scored = df.withColumn("_p", heads.probabilities(df.sparkSession, F.col(text)))
    entries = [
        x for i, aspect in enumerate(heads.names) for x in (F.lit(aspect), aspect_result(F.slice("_p", i * n + 1, n)))
    ]
    return scored.withColumn("aspects", F.create_map(*entries)).select(*df.columns, "aspects")


def document_sentiment(scored: DataFrame, primary: str = "general") -> DataFrame:
    """Label, score and confidence of the primary aspect as the post's own."""
    chosen = F.col("aspects")[primary]
    return scored.select(
        "*",
        chosen["label"].alias("sentiment_label"),
        chosen["score"].alias("sentiment_score"),
        chosen["confidence"].alias("confidence"),
    )


def confident(scored: DataFrame, threshold: float) -> DataFrame:
    """Rows whose confidence reaches the threshold."""
    return scored.filter(F.col("confidence") >= threshold)


# --- evaluation ----------------------------------------------------------------------------


def confusion_matrix(predictions: DataFrame, classes: list) -> DataFrame:
    """One row per true class, one column per predicted class."""
    return (
        predictions.groupBy("label")
        .pivot("prediction", classes)
        .agg(F.count(F.lit(1)))
        .na.fill(0)
        .select("label", *[F.col(str(c)).alias(f"predicted_{c}") for c in classes])
    )


def class_counts(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Hits, predicted and true rows per class, in one aggregation over both roles."""
    by = by or []
    hit = (F.col("label") == F.col("prediction")).cast("bigint")
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    roles = F.array(
        F.struct(F.col("label").alias("c"), hit.alias("hit"), zero.alias("said"), one.alias("real")),
        F.struct(F.col("prediction").alias("c"), zero.alias("hit"), one.alias("said"), zero.alias("real")),
    )
    return (
        predictions.select(*by, F.explode(roles).alias("r"))
        .groupBy(*by, F.col("r.c").alias("class"))
        .agg(F.sum("r.hit").alias("hits"), F.sum("r.said").alias("said"), F.sum("r.real").alias("support"))
    )


def _ratio(part, whole):
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def classification_report(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class; predictions: label, prediction."""
    return class_counts(predictions, by).select(
        *(by or []),
        "class",
        rounded(_ratio(F.col("hits"), F.col("said")), 6).alias("precision"),
        rounded(_ratio(F.col("hits"), F.col("support")), 6).alias("recall"),
        rounded(_ratio(2 * F.col("hits"), F.col("said") + F.col("support")), 6).alias("f1"),
        "support",
    )


def macro_f1(predictions: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean F1 over classes; with `by`, one row per group such as a model name."""
    f1 = _ratio(2 * F.col("hits"), F.col("said") + F.col("support"))
    counts = class_counts(predictions, by)
    grouped = counts.groupBy(*by) if by else counts.groupBy()
    return grouped.agg(
        rounded(F.avg(f1), 6).alias("macro_f1"), F.sum("support").alias("texts")
    )


def promotion_gate(
    candidate: DataFrame, production: DataFrame, new_labels: DataFrame, min_new_labels: int = 200
) -> DataFrame:
    """One row: both macro F1 values, new labels, and whether the candidate is promoted.

    candidate and production: label, prediction on the same held-out texts.
    """
    both = candidate.select(F.lit("candidate").alias("model"), "label", "prediction").unionByName(
        production.select(F.lit("production").alias("model"), "label", "prediction")
    )
    scores = macro_f1(both, ["model"])
    fresh = new_labels.agg(F.count(F.lit(1))).scalar()
    row = scores.agg(
        F.max(F.when(F.col("model") == "candidate", F.col("macro_f1"))).alias("candidate_f1"),
        F.max(F.when(F.col("model") == "production", F.col("macro_f1"))).alias("production_f1"),
    ).withColumn("new_labels", fresh)
    enough = F.col("new_labels") >= min_new_labels
    better = F.col("candidate_f1") >= F.col("production_f1")
    return row.withColumn("promoted", F.coalesce(enough & better, F.lit(False)))
