"""The pipeline's stages on their own input, and the whole run."""

from collections import Counter

import pytest

import corpus_pipeline
from postlens.llm import langid, quality
from tests.llm.test_text_operators import expected_components
from tests.llm.test_tokens import check_packing

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents and what each stage leaves, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    frames = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frames[-1], SF_DIR).write.parquet(f"{folder}/{name}")
        frames.append(spark.read.parquet(f"{folder}/{name}"))
    return frames


def texts(frame):
    return [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]


def test_names_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_copies", "packing"]
    assert all(frame.columns == stages[0].columns for frame in stages[:-1])


def test_quality_stage(spark, stages):
    docs, kept = texts(stages[0]), {i for i, _ in texts(stages[1])}
    classifier = quality.fit_classifier(stages[0], spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    scores = classifier([t for _, t in docs])
    assert kept == {i for (i, _), score in zip(docs, scores) if score >= 0.5}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert sum(i in kept for i in labels if labels[i]) / sum(labels.values()) > 0.97


def test_language_stage(stages):
    model = langid.fit_model(stages[1])
    kept = {i for i, _ in texts(stages[2])}
    for doc_id, text in texts(stages[1]):
        name, score = model(text)
        assert (doc_id in kept) == (name != "und" and score >= model.threshold)


def test_near_copy_stage(stages):
    rows = texts(stages[2])
    expected = {i for i, n, c in expected_components(rows) if i == c}
    assert Counter(i for i, _ in texts(stages[3])) == Counter(expected)


def test_packing_stage(stages):
    check_packing(stages[4].collect(), texts(stages[3]))


def test_run_gives_the_same(spark, stages):
    whole = Counter((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert whole == Counter((r.doc_id, r.piece, r.ids_crc32) for r in stages[4].collect())


def test_stages_of_an_empty_table(spark):
    empty = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).collect() == []
