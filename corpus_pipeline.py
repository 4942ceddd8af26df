"""The documents that a training run would read: good ones in a known language, one of each group of near copies, packed."""

from pyspark.sql import DataFrame, SparkSession

from postlens.llm import jaccard, langid, packing, quality
from postlens.llm.common import stored, table


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not score under 0.5; null and empty texts get the score of no difference."""
    classifier = quality.fit_classifier(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.quality_score(classifier) >= 0.5)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model names; texts without a letter and those under its threshold go."""
    model = langid.fit_model(docs)
    return docs.where(~langid.language(model)["rejected"])


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of each component whose doc_id is its least; documents without words are in no group and stay."""
    return jaccard.one_of_each_component(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    return packing.packed_documents(docs)


STAGES = [
    ("quality", drop_low_quality),
    ("language", drop_unknown_language),
    ("near_copies", keep_one_of_each_group),
    ("packing", pack),
]

# The classifiers and the tokenizer have no form in SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents, each written before the next one reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE = {}
