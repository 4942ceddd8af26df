"""Quality and language: held-out accuracy, odd rows, and formulas against plain versions."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import langid, quality, queries
from postlens.llm.common import held_out

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, label int, place int"
ODD = [
    (None, None, None, None, None, 0.5, 1, 1),
    (1, None, "en", "s", 0, 0.5, 1, 1),
    (2, "", "en", "s", 0, 0.5, 1, 1),
    (2, "", "en", "s", 0, 0.5, 1, 1),
    (3, "12 34 !!", "en", "s", 0, 0.5, 1, 1),
    (4, "the and of " * 20000, "en", "s", 0, 0.5, 1, 1),
    (5, "漢字 かな", "ja", "s", 0, 0.5, 1, 1),
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas().set_index("doc_id")


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_held_out_fold(spark):
    rows = spark.range(500).select("id", held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == fold(r.id) for r in rows)
    assert spark.sql("SELECT cast(null AS bigint) id").select(held_out(F.col("id")).alias("o")).first().o is False


def test_quality_query(spark, documents):
    scored = queries.QUERIES["op1_compression_quality"](spark, SF_DIR).toPandas().set_index("doc_id")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas().set_index("doc_id")
    assert sorted(scored.index) == sorted(documents.index)
    assert scored["score"].between(0, 1).all()
    assert (scored["predicted"] == (scored["score"] >= 0.5).astype(int)).all()
    assert all(fold(i) == out for i, out in scored["held_out"].items())
    tested = scored.join(labels, how="inner").query("held_out")
    assert (tested["predicted"] == tested["quality"]).mean() > 0.95
    assert (tested.query("quality == 1")["predicted"] == 1).mean() > 0.98


def test_size_difference_by_hand():
    good, bad = b"good text and more of it " * 40, b"BAD!! TEXT!! " * 80
    measure = quality.SizeDifference(good, bad)
    text = "good text and more of it " * 100
    data, total = text.encode(), 0
    for start in range(0, len(data), quality.BLOCK_BYTES):
        block = data[start : start + quality.BLOCK_BYTES]
        total += len(measure.bad(block)) - len(measure.good(block))
    assert measure(text) == total / len(data) > 0
    assert measure("BAD!! TEXT!! " * 100) < 0
    assert measure(None) == measure("") == 0


def test_logistic_finds_the_border():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0.1, 0.02, 300), rng.normal(-0.1, 0.02, 100)])
    slope, shift = quality.logistic(x, np.array([1] * 300 + [0] * 100))
    p = 1 / (1 + np.exp(-(slope * x + shift)))
    assert ((p >= 0.5) == ([True] * 300 + [False] * 100)).all()


def test_quality_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    labels = spark.createDataFrame(
        [(4, 1, None), (4, 1, None), (5, 0, 1), (99, 0, 0), (None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int"
    )
    for known in (labels, labels.limit(0)):
        rows = docs.select("doc_id", quality.quality_score(quality.fit_classifier(docs, known)).alias("s")).collect()
        assert len(rows) == len(ODD)
        assert all(0 <= r.s <= 1 for r in rows)
    none = docs.limit(0)
    classifier = quality.fit_classifier(none, labels)
    assert none.select(quality.quality_score(classifier).alias("s")).collect() == []
    assert docs.select(quality.quality_score(classifier).alias("s")).first().s == 0.5


def test_language_query(spark, documents):
    named = queries.QUERIES["op5_subword_language"](spark, SF_DIR).toPandas().set_index("doc_id")
    assert sorted(named.index) == sorted(documents.index)
    assert named["score"].between(0, 1).all()
    tested = named[named["held_out"]]
    assert all(fold(i) == out for i, out in named["held_out"].items())
    assert (tested["lang_pred"] == documents.loc[tested.index, "lang"]).mean() > 0.95
    assert named["rejected"].mean() < 0.01


def test_language_odd_rows(spark):
    docs = spark.createDataFrame(ODD, SCHEMA)
    model = langid.fit_model(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    rows = docs.select("doc_id", langid.language(model).alias("l")).collect()
    for row, source in zip(rows, ODD):
        letters = any(c.isalpha() for c in source[1] or "")
        assert (row.l.lang_pred == "und") == (not letters)
        assert row.l.rejected or letters
    assert docs.limit(0).select(langid.language(model).alias("l")).collect() == []
    nothing = langid.fit_model(docs.limit(0))
    assert {r.l.lang_pred for r in docs.select(langid.language(nothing).alias("l")).collect()} == {"und"}


def test_table_equals_embeddings_then_softmax():
    """One look-up a subword is the same as averaging embeddings first."""
    samples = [("a", "the and of to"), ("b", "der die das und")] * 10
    model = langid.train(samples)
    text = "the die"
    buckets = langid.subwords(text)
    mean = np.mean([model.table[b] for b in buckets], axis=0)
    assert np.allclose(model.logits(text), mean + model.shifts)
    assert model("der die das und")[0] == "b"


def test_subwords_fold_case_and_marks():
    assert langid.subwords("The, Cat").tolist() == langid.subwords("the cat").tolist()
    assert len(langid.subwords("")) == 0 or langid.subwords("").dtype == np.int64
    assert langid.subwords("a").tolist() == langid.subwords("A").tolist()
