"""Keyed merges: first copy wins, or named columns are refreshed.

These return the merged DataFrame. Writing it to a table is in sources.sinks.
"""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def one_per_key(
    df: DataFrame, keys: list[str], order: list[str] | None = None, last: bool = False
) -> DataFrame:
    """One row per key: the first (or last) by order, ties by all comparable columns.

    Spark limits each map task to one row per key before the shuffle, so a key with very many
    copies does not meet in one task.
    """
    by = [F.desc(c) if last else F.asc(c) for c in order or []]
    by.append(F.xxhash64(*[F.to_json(c) if _is_map(df, c) else F.col(c) for c in df.columns]))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*by))
    return df.withColumn("_n", rank).filter(F.col("_n") == 1).drop("_n")


def _is_map(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() == "map"


def new_rows(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """Source rows whose key is not in target, one per key."""
    return one_per_key(source, keys, order).join(target.select(*keys), keys, "left_anti")


def insert_ignore(
    target: DataFrame, source: DataFrame, keys: list[str], order: list[str] | None = None
) -> DataFrame:
    """Target plus the rows of source with new keys; existing rows stay as they are."""
    fresh = new_rows(target, source, keys, order).select(*target.columns)
    return target.unionByName(fresh)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str] | None = None,
    order: list[str] | None = None,
) -> DataFrame:
    """Target with source merged in.

    On a key both hold, the columns in `update` (default: all others) take the source's value,
    NULL included; the rest keep the target's. With several source rows per key the last by
    order wins.
    """
    others = [c for c in target.columns if c not in keys]
    update = others if update is None else update
    incoming = one_per_key(source, keys, order, last=True).select(
        *keys, F.struct(*others).alias("_new")
    )
    existing = target.select(*keys, F.struct(*others).alias("_old"))
    merged = existing.join(incoming, keys, "full")
    columns = []
    for name in others:
        old, new = F.col(f"_old.{name}"), F.col(f"_new.{name}")
        known, arrived = F.col("_old").isNotNull(), F.col("_new").isNotNull()
        if name in update:
            columns.append(F.when(arrived, new).otherwise(old).alias(name))
        else:
            columns.append(F.when(known, old).otherwise(new).alias(name))
    merged_columns = merged.select(*keys, *columns)
    return merged_columns.select(*target.columns)


# Columns refreshed when a scored post arrives again; its other columns stay as first written.
RESCORED = ["sentiment_score", "sentiment_label", "confidence"]


def explode_aspects(enriched: DataFrame, *keep: str) -> DataFrame:
    """Long form of the aspects map: one row per post and aspect, beside the kept columns."""
    return enriched.select(
        "post_id", "platform", *keep, F.explode("aspects").alias("aspect", "result")
    ).select(
        "post_id",
        "platform",
        *keep,
        "aspect",
        F.col("result.label").alias("sentiment_label"),
        F.col("result.score").alias("sentiment_score"),
        F.col("result.confidence").alias("confidence"),
    )


def search_documents(enriched: DataFrame) -> DataFrame:
    """Enriched posts as documents: an id and the aspects map as an array of structs."""
    nested = F.transform(
        F.map_entries("aspects"),
        lambda e: F.struct(
            e.key.alias("aspect"), e.value.label.alias("label"), e.value.score.alias("score")
        ),
    )
    return enriched.withColumn("aspects", nested).withColumn(
        "doc_id", F.concat_ws("_", "platform", "post_id")
    )


def as_messages(df: DataFrame, key: str = "post_id") -> DataFrame:
    """Rows as (key, JSON value), the form in which a topic or a JSON sink takes them."""
    return df.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct(*df.columns)).alias("value")
    )
