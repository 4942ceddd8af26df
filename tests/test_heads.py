"""Heads trained together: against a plain descent on dense arrays, their scores in SQL, heads with nothing to learn, odd rows."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.operators import heads, models
from postlens.schemas import ASPECTS, LABELS
from postlens.session import BATCH

WORDS = ["slow", "fast", "broken", "great", "price", "help", "crash", "fine", "menu", "late"]


def labelled(spark, seed=4, rows=120):
    rng = random.Random(seed)
    out = []
    for i in range(rows):
        words = rng.choices(WORDS, k=rng.randint(1, 9))
        mood = ("great" in words or "fast" in words) - ("broken" in words or "crash" in words)
        out.append((i, " ".join(words), {"general": 1 + mood, "product_quality": 0 if "broken" in words else 2, "pricing_value": 1}))
    return spark.createDataFrame(out, "id int, clean_text string, labels map<string,int>").repartition(3)


def test_loss_is_the_least_one(spark):
    df = labelled(spark)
    model = models.train_aspect_heads(df, features=64, max_iter=200, tolerance=1e-4, balanced=False).heads
    assert model.converged and 0 < model.iterations < 200
    rows = df.select(heads.buckets(F.col("clean_text"), 64).alias("b"), "labels").collect()
    row, bucket, value = heads.vectors([r.b for r in rows], model.idf)
    x = np.zeros((len(rows), 64))
    x[row, bucket] = value
    loss = 0.0
    for name, classes in (("general", [0, 1, 2]), ("product_quality", [0, 2])):
        y = np.array([classes.index(r["labels"][name]) for r in rows])
        w, b, hit = np.zeros((64, len(classes))), np.zeros(len(classes)), np.eye(len(classes))[y]
        speed_w, speed_b = np.zeros_like(w), np.zeros_like(b)
        for _ in range(20000):
            p = np.exp(x @ w + b)
            p /= p.sum(axis=1, keepdims=True)
            # With momentum, as plain steps are still 0.5 % away after as many rounds.
            speed_w = 0.98 * speed_w - 0.02 * (x.T @ (p - hit) / len(rows) + 5e-3 * w)
            speed_b = 0.98 * speed_b - 0.02 * (p - hit).mean(axis=0)
            w += speed_w
            b += speed_b
        loss += -np.log((p * hit).sum(axis=1)).mean() + 5e-3 / 2 * (w * w).sum()
    assert model.loss == pytest.approx(loss, rel=1e-3)


def test_heads_without_two_classes_are_reported(spark):
    model = models.train_aspect_heads(labelled(spark), features=64).heads
    assert model.trained == {a: a in ("general", "product_quality") for a in ASPECTS}
    assert model.missing["general"] == [] and model.missing["product_quality"] == [1] and model.missing["ui_performance"] == [0, 2]
    report = {r["head"]: r for r in model.report(spark).collect()}
    assert report["product_quality"].bias[1] < -1e8 and report["general"].converged


def test_scores_equal_sql_over_exported_weights(spark, tmp_path):
    df = labelled(spark)
    model = models.train_aspect_heads(df, features=16)
    df.select("id", "clean_text").write.parquet(str(tmp_path / "texts"))
    terms = spark.createDataFrame([(w,) for w in WORDS], "term string")
    model.heads.term_weights(terms).write.parquet(str(tmp_path / "weights"))
    model.heads.report(spark).selectExpr("head", "posexplode(bias) AS (class, bias)").write.parquet(str(tmp_path / "bias"))
    theirs = duckdb.sql(f"""
      WITH w AS (SELECT * FROM '{tmp_path}/weights/*.parquet'),
      t AS (
        SELECT id, bucket, count(*) * any_value(idf) AS v
        FROM (SELECT id, unnest(string_split(clean_text, ' ')) AS term FROM '{tmp_path}/texts/*.parquet')
        JOIN (SELECT DISTINCT term, bucket, idf FROM w) USING (term) GROUP BY id, bucket),
      n AS (SELECT id, sqrt(sum(v * v)) AS n FROM t GROUP BY id),
      s AS (
        SELECT id, head, class, sum({heads.LENGTH} * v / n * weight) AS s
        FROM t JOIN n USING (id) JOIN (SELECT DISTINCT bucket, head, class, weight FROM w) USING (bucket) GROUP BY id, head, class),
      e AS (SELECT id, head, class, exp(s + bias) AS e FROM s JOIN '{tmp_path}/bias/*.parquet' USING (head, class))
      SELECT id, head, class, e / sum(e) OVER (PARTITION BY id, head) FROM e""").fetchall()
    p = {(i, h, c): x for i, h, c, x in theirs}
    ours = model(df.select("id", "clean_text")).collect()
    assert len(p) == len(ours) * len(ASPECTS) * len(LABELS)
    for r in ours:
        for aspect, found in r.aspects.items():
            for c, name in enumerate(LABELS):
                assert found.probabilities[name] == pytest.approx(p[r.id, aspect, c], abs=6e-5)
            assert p[r.id, aspect, LABELS.index(found.label)] == pytest.approx(max(p[r.id, aspect, c] for c in range(3)))


def test_odd_texts_and_no_rows(spark):
    model = models.train_aspect_heads(labelled(spark), features=64)
    texts = spark.createDataFrame([(None,), ("",), ("great " * 30000,), ("unseenword",)], "clean_text string")
    found = model(texts).collect()
    assert len(found) == 4 and found[0].aspects == found[1].aspects
    assert found[2].aspects["general"].label == "positive"
    nothing = models.train_aspect_heads(labelled(spark).limit(0), features=64)
    assert not any(nothing.heads.trained.values())
    assert all(math.isclose(x, 1 / 3, abs_tol=1e-4) for x in nothing(texts).first().aspects["general"].probabilities)


def test_training_asks_for_small_batches(spark):
    """Blocks of a task do not reach a worker all at once."""
    for setting in BATCH:
        spark.conf.unset(setting)
    rows = spark.createDataFrame([("good thing", {"general": 2}), ("bad thing", {"general": 0})], "clean_text string, labels map<string, int>")
    models.train_aspect_heads(rows, max_iter=1)
    assert {setting: spark.conf.get(setting) for setting in BATCH} == BATCH


def test_texts_are_scored_once_whatever_is_asked_of_the_results(spark):
    """An explode, or a condition on a result, must not bring a second scoring under a filter."""
    df = labelled(spark)
    scored = models.document_sentiment(models.train_aspect_heads(df, features=64)(df.select("id", "clean_text")))
    rows = scored.select("id", "confidence", F.explode("aspects").alias("aspect", "r"))
    confident = models.confident(scored, 0.5).select("id")
    for asked in (rows, confident):
        plan = asked._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython [score(") == 1
    assert rows.count() == 120 * len(ASPECTS)
