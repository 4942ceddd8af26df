"""Topics and models on small corpora."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.operators import language, models, topics
from postlens.operators.filters import topic_corpus
from postlens.schemas import ASPECTS
from postlens.sources.adapters import Tables

CLOUD = ["server outage again today", "outage of the server cluster", "cluster server down outage"]
MONEY = ["invoice price too high", "high price on the invoice", "billing invoice price high"]
DOCS = [(str(i), text) for i, text in enumerate((CLOUD + MONEY) * 5)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "post_id string, clean_text string")


def test_tfidf_equals_plain_python(docs):
    vectors, terms = topics.tfidf(docs, stop_words=["the", "of", "on"], max_features=8)
    found = {}
    for row in topics.tfidf_rows(vectors, terms, "post_id").collect():
        found.setdefault(row.post_id, {})[row.term] = row.weight
    words = {k: [w for w in re.findall(r"\w\w+", t) if w not in ("the", "of", "on")] for k, t in DOCS}
    uses = Counter(w for ws in words.values() for w in ws)
    df = Counter(w for ws in words.values() for w in set(ws))
    kept = sorted((w for w in df if 2 <= df[w] <= 0.95 * len(DOCS)), key=lambda w: (-uses[w], w))[:8]
    assert terms == kept
    for key, ws in words.items():
        raw = {w: n * (math.log((1 + len(DOCS)) / (1 + df[w])) + 1) for w, n in Counter(ws).items() if w in kept}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        assert found[key] == pytest.approx({w: x / norm for w, x in raw.items()})


def test_nmf_separates_two_themes(docs):
    assigned, terms = topics.discover_topics(docs, nr_topics=2)
    topic = {r.post_id: r.topic_id for r in assigned.collect()}
    cloud = {topic[k] for k, t in DOCS if t in CLOUD}
    money = {topic[k] for k, t in DOCS if t in MONEY}
    assert len(cloud) == len(money) == 1 and cloud != money
    assert "outage" in terms[cloud.pop()][:3] and "invoice" in terms[money.pop()][:3]


def alternating(v, topics, seed, rounds=200):
    """Half the squared error of plain alternating projected least squares from a random start."""
    rng = np.random.default_rng(seed)
    w, h = rng.random((len(v), topics)), rng.random((topics, v.shape[1]))
    for _ in range(rounds):
        w *= (v @ h.T) / (w @ h @ h.T + 1e-12)
        h *= (w.T @ v) / (w.T @ w @ h + 1e-12)
    return ((v - w @ h) ** 2).sum() / 2


def test_factors_reach_the_error_of_a_plain_factorisation(spark):
    """The objective equals SQL over the exported factors and is within 1 % of the best of three plain runs."""
    texts = Tables(spark, "/root/testdata/sf0.001").document_posts().select("post_id", F.col("text").alias("clean_text"))
    found = topics.factor_topics(texts, nr_topics=6, max_features=200)
    factors = found.factors
    assert factors.converged and 0 < factors.iterations < 200
    values = topics.tfidf_rows(found.vectors, found.vocabulary, "post_id").toPandas()  # noqa: F841
    topic = topics.topic_rows(spark, factors.topics, found.vocabulary).toPandas()  # noqa: F841
    weight = topics.document_weights(found.vectors, "post_id", factors.topics).toPandas()  # noqa: F841
    # |v - wh|^2 = |v|^2 - 2 v.wh + |wh|^2, so that no zero of v is needed.
    ((by_sql,),) = duckdb.sql("""
      WITH w AS (SELECT post_id, unnest(weights) AS x, unnest(range(len(weights))) AS topic_id FROM weight),
      wh AS (SELECT post_id, term, sum(x * weight) AS x FROM w JOIN topic USING (topic_id) GROUP BY ALL)
      SELECT ((SELECT sum(weight * weight) FROM values) + (SELECT sum(x * x) FROM wh)
        - 2 * (SELECT sum(weight * x) FROM values JOIN wh USING (post_id, term))) / 2""").fetchall()
    assert factors.objective == pytest.approx(by_sql, rel=1e-4)
    place = {term: j for j, term in enumerate(found.vocabulary)}
    keys = {key: i for i, key in enumerate(sorted(weight.post_id))}
    v = np.zeros((len(keys), len(place)))
    v[values.post_id.map(keys), values.term.map(place)] = values.weight
    assert factors.objective <= 1.01 * min(alternating(v, len(factors.topics), seed) for seed in range(3))
    again = topics.factor_topics(texts, nr_topics=6, max_features=200)
    assert again.factors.topics == pytest.approx(factors.topics, abs=1e-6)


def test_factorisation_that_is_cut_short_says_so(spark):
    texts = Tables(spark, "/root/testdata/sf0.001").document_posts().select("post_id", F.col("text").alias("clean_text"))
    found = topics.factor_topics(texts, nr_topics=6, max_features=200, rounds=1)
    assert (found.factors.iterations, found.factors.converged) == (1, False)
    assert found.assigned.count() == texts.count()


def test_topic_rows_carry_their_coherence(docs):
    found = topics.factor_topics(docs, nr_topics=2)
    scored = topics.topic_coherence(docs, "clean_text", found.terms)
    posts = docs.join(found.assigned, "post_id").withColumns({"sentiment_label": F.lit("neutral"), "sentiment_score": F.lit(0.0)})
    rows = topics.topic_clusters(posts, topics.keyword_frame(docs.sparkSession, found.terms), "2024-01-31", scored).collect()
    assert {r.topic_id: r.coherence_score for r in rows} == {r.topic_id: r.coherence for r in scored.collect()}
    assert len(rows) == 2 and all(-1 <= r.coherence_score <= 1 for r in rows)
    assert topics.topic_coherence(docs, "clean_text", []).collect() == []


def test_small_corpus_gives_its_topics(docs):
    assigned, terms = topics.discover_topics(docs.limit(3))
    assert assigned.count() == 3 and terms
    assigned, terms = topics.discover_topics(docs.limit(0))
    assert terms == [] and assigned.count() == 0


def test_topic_corpus_bounds(spark):
    rows = [("x" * 15, False), ("x" * 16, False), ("x" * 16, True)]
    df = spark.createDataFrame(rows, "clean_text string, is_spam boolean")
    assert [len(r.clean_text) for r in topic_corpus(df).collect()] == [16]


def test_topic_metrics_leaves_outliers_out(spark):
    rows = [("3", 0, "c", "positive", 1.0), ("1", 0, "a", "negative", -1.0), ("2", 0, "b", "neutral", 0.0), ("4", -1, "d", "neutral", 0.0)]
    df = spark.createDataFrame(
        rows, "post_id string, topic_id int, clean_text string, sentiment_label string, sentiment_score double"
    )
    (row,) = topics.topic_metrics(df).collect()
    assert (row.topic_id, row.post_count, row.positive_ratio) == (0, 3, 0.3333)
    assert row.representative_samples == ["a", "b"]


def test_keyword_frame(spark):
    found = topics.keyword_frame(spark, [["cloud", "server", *"abcdefgh"], []]).orderBy("topic_id").collect()
    assert found[0].topic_label == "Cloud & Server" and len(found[0].top_keywords) == 8
    assert found[1].topic_label == "Topic 1"


def test_embedding_clusters_under_min_size_are_outliers(spark):
    rows = [(i, [1.0, 0.0]) for i in range(20)] + [(99, [50.0, 50.0])]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    found = {r.vec_id: r.topic_id for r in topics.embedding_topics(df, nr_topics=2, min_size=5).collect()}
    assert found[99] == topics.OUTLIER and found[0] != topics.OUTLIER


def test_coherence_of_words_that_always_meet(docs):
    scored = topics.topic_coherence(docs, "clean_text", [["outage", "server"], ["outage", "invoice"]])
    found = {r.topic_id: r.coherence for r in scored.collect()}
    assert found == {0: 1.0, 1: -1.0}


def test_aspect_result(spark):
    row = spark.range(1).select(
        models.aspect_result(F.array(F.lit(0.2), F.lit(0.4), F.lit(0.4))).alias("tie"),
        models.aspect_result(F.array(F.lit(0.0), F.lit(1.0))).alias("two"),
    ).first()
    assert (row.tie.label, row.tie.score, row.tie.confidence) == ("neutral", 0.0, 0.4)
    assert row.two.label == "neutral" and row.two.probabilities.positive == 0.0


def test_heads_learn_and_score_every_aspect(spark):
    rows = [(t, {"general": 0, "product_quality": 0}) for t in CLOUD] + [(t, {"general": 2}) for t in MONEY]
    labelled = spark.createDataFrame(rows * 5, "clean_text string, labels map<string,int>")
    model = models.train_aspect_heads(labelled, features=1 << 10)
    scored = models.document_sentiment(model(labelled.select("clean_text")))
    for row in scored.collect():
        assert row.sentiment_label == ("negative" if row.clean_text in CLOUD else "positive")
        assert set(row.aspects) == set(ASPECTS)
        assert row.aspects["pricing_value"].label == "neutral"
        assert sum(row.aspects["general"].probabilities) == pytest.approx(1, abs=1e-3)
    assert models.confident(scored, 1.01).count() == 0


def test_class_balance_counts_absent_as_neutral(spark):
    df = spark.createDataFrame([({"general": 0},), ({},)], "labels map<string,int>")
    found = {(r.aspect, r.label): r.share_pct for r in models.class_balance(df, ["general"]).collect()}
    assert found == {("general", 0): 50.0, ("general", 1): 50.0}


def test_split_is_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "post_id")
    first = {r.post_id: r.split for r in models.split_curated(df, "post_id").collect()}
    second = {r.post_id: r.split for r in models.split_curated(df.repartition(7), "post_id").collect()}
    assert first == second and 700 < sum(s == "train" for s in first.values()) < 900


def test_gate(spark):
    good = spark.createDataFrame([(0, 0), (1, 1)], "label int, prediction int")
    bad = spark.createDataFrame([(0, 1), (1, 1)], "label int, prediction int")
    labels = spark.range(200)
    assert models.promotion_gate(good, bad, labels).first().promoted
    assert models.promotion_gate(good, good, labels).first().promoted
    assert not models.promotion_gate(bad, good, labels).first().promoted
    assert not models.promotion_gate(good, bad, spark.range(199)).first().promoted


def test_language_model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labelled = language.with_clean_text(docs).withColumnRenamed("lang", "language")
    model = language.train_language_model(labelled)
    found = language.detect_language(labelled.withColumnRenamed("language", "truth"), model)
    right = found.agg(F.avg((F.col("truth") == F.col("language")).cast("int"))).first()[0]
    assert right > 0.9
    short = spark.createDataFrame([("der die",), ("",)], "clean_text string")
    assert {r.language for r in language.detect_language(short, model).collect()} == {"en"}


def test_coherence_reads_the_texts_once(docs):
    scored = topics.topic_coherence(docs, "clean_text", [["outage", "server"], ["outage", "invoice"]])
    assert "regexp_extract_all" not in scored._jdf.queryExecution().optimizedPlan().toString()


def test_term_statistics_count_uses_and_documents(spark):
    rows = spark.createDataFrame([(["a", "b", "a"],), (["a"],), ([],), (None,)], "w array<string>")
    found = topics.term_statistics(rows, "w")
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, found.collect())) == [("a", 3, 2), ("b", 1, 1)]
