"""Keyed tables on plain Parquet, safe to write twice.

A table is a folder partitioned by a hash bucket of the key and, if its key fixes a time, by the day
of that time. A write reads only the partitions that hold the batch's keys. Inserts append; an
upsert rewrites the touched partitions. The new partitions are first written whole beside the
table and marked ready, then swapped in and marked done, so a swap that was broken off is taken up
again by the next write.
"""

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators.keyed import as_messages, new_rows, one_per_key, upsert
from postlens.session import cut_lineage

DAY = "day"
BUCKET = "key_bucket"
PARTITIONS = [DAY, BUCKET]


@dataclass(frozen=True)
class KeyedTable:
    """path: folder. keys: unique key. time: a column that the key fixes, whose day partitions the table.

    Without a time rows of one key meet in one bucket whatever their other columns, so the key is
    unique in the whole table. With small batches, more buckets mean that a batch touches a smaller part.
    """

    path: str
    keys: list[str]
    time: str | None = None
    buckets: int = 1

    @property
    def partitions(self) -> list[str]:
        return PARTITIONS if self.time else [BUCKET]

    def read(self, spark: SparkSession) -> DataFrame | None:
        return read_if_there(spark, self.path)

    def placed(self, df: DataFrame) -> DataFrame:
        """df with the partition columns."""
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        dated = df.withColumn(DAY, F.to_date(self.time)) if self.time else df
        return dated.withColumn(BUCKET, bucket)

    def touched(self, spark: SparkSession, batch: DataFrame) -> DataFrame | None:
        """The stored rows of the batch's partitions.

        They are found by a join with the distinct partitions of the batch, which prunes files at run time; the
        driver sees no list of them.
        """
        stored = self.read(spark)
        if stored is None:
            return None
        return stored.join(batch.select(*self.partitions).distinct(), self.partitions, "left_semi").select(*stored.columns)


def read_if_there(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException as problem:
        if problem.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _append(table: KeyedTable, df: DataFrame) -> None:
    df.write.mode("append").partitionBy(*table.partitions).parquet(table.path)


def _mark(table: KeyedTable, spark: SparkSession, state: str, write_id: str) -> None:
    one = spark.createDataFrame([(write_id,)], "id string").coalesce(1)
    one.write.mode("overwrite").json(f"{table.path}__{state}")


def _marked(table: KeyedTable, spark: SparkSession, state: str) -> str | None:
    found = read_if_there(spark, f"{table.path}__{state}", "json")
    row = found.first() if found is not None and found.columns else None
    return row.id if row else None


def _stage(table: KeyedTable, df: DataFrame) -> str:
    """Write df whole beside the table; it counts from when it is marked ready."""
    write_id = uuid.uuid4().hex
    df.write.parquet(f"{table.path}__staged/{write_id}")
    _mark(table, df.sparkSession, "ready", write_id)
    return write_id


def _swap(table: KeyedTable, spark: SparkSession, write_id: str) -> None:
    """Put the staged partitions in place of the table's. Doing it again changes nothing."""
    staged = spark.read.parquet(f"{table.path}__staged/{write_id}")
    staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *table.partitions
    ).parquet(table.path)
    spark.catalog.refreshByPath(table.path)
    _mark(table, spark, "done", write_id)


def recover(table: KeyedTable, spark: SparkSession) -> None:
    """Finish a swap that was broken off after it was ready."""
    ready = _marked(table, spark, "ready")
    if ready and ready != _marked(table, spark, "done"):
        _swap(table, spark, ready)


def insert_ignore_into(table: KeyedTable, batch: DataFrame, order: list[str] | None = None) -> None:
    """Append the rows with new keys."""
    recover(table, batch.sparkSession)
    dated = cut_lineage(table.placed(batch))
    stored = table.touched(batch.sparkSession, dated)
    if stored is None:
        fresh = one_per_key(dated, table.keys, order)
    else:
        fresh = new_rows(stored, dated, table.keys, order)
    _append(table, fresh)


def upsert_into(
    table: KeyedTable,
    batch: DataFrame,
    update: list[str] | None = None,
    order: list[str] | None = None,
) -> None:
    """Merge the batch into its partitions and swap those in."""
    spark = batch.sparkSession
    recover(table, spark)
    dated = cut_lineage(table.placed(batch))
    stored = table.touched(spark, dated)
    if stored is None:
        _append(table, one_per_key(dated, table.keys, order, last=True))
        return
    _swap(table, spark, _stage(table, upsert(stored, dated, table.keys, update, order)))


def replace_days(table: KeyedTable, df: DataFrame) -> None:
    """Write whole days anew, as a rerun of a daily job does. The table needs a time."""
    table.placed(df).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*PARTITIONS).parquet(table.path)


def append_snapshot(path: str, df: DataFrame, taken_at=None) -> None:
    """Append all rows under one timestamp, which is also the partition's day."""
    moment = F.current_timestamp() if taken_at is None else F.lit(taken_at).cast("timestamp")
    stamped = df.withColumn("calculated_at", moment)
    stamped.withColumn(DAY, F.to_date("calculated_at")).write.mode("append").partitionBy(
        DAY
    ).parquet(path)


def write_messages(df: DataFrame, path: str, key: str = "post_id") -> None:
    """Rows as JSON lines, the file form of a topic."""
    as_messages(df, key).write.mode("append").json(path)


def publish(df: DataFrame, servers: str, topic: str, key: str = "post_id") -> None:
    """Rows as messages of a Kafka topic. Needs the Kafka connector package."""
    as_messages(df, key).write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()
