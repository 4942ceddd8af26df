"""Session settings and the shared folder for checkpoints and written tables."""

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on. Partition counts are left to AQE, which starts from the initial
# number and merges small ones; a cluster job sets the initial number for its own data size.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores="8", name="postlens", shuffle_partitions=8, memory="8g", extra=None):
    """A single-machine session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **(extra or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by spark.checkpoint.dir.

    Only a local master, where driver and executors are one process, gets a folder made here.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        path = tempfile.mkdtemp(prefix="postlens-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(path)
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path not used before inside the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to reliable storage and go on from the copy."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def rewritten(df: DataFrame, name: str = "rewritten") -> DataFrame:
    """Write df to the shared folder and go on from the written table, of which the planner knows size and columns only."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROWS_PER_PARTITION = 1_000_000


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def fixed_partitioning(spark: SparkSession, rows: int, least: int = 1):
    """Keep hash partitions as planned, so that checkpointed inputs of a loop stay co-located.

    Adaptive planning would merge partitions between rounds and shuffle the inputs again; without
    it the number of partitions follows from the number of rows, with a task per core and `least` tasks at least.
    Yields that number.
    """
    cores = spark.sparkContext.defaultParallelism
    partitions = max(cores, least, -(-rows // ROWS_PER_PARTITION))
    settings = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": str(partitions),
    }
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield partitions
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


# What a Python worker gets at a time: so many rows and bytes.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def small_batches(spark: SparkSession) -> None:
    """Python functions over long texts get small batches from now on.

    A worker holds a batch several times over (Arrow, strings, results), so with Spark's 10,000 rows its memory follows
    the rows of a task. The settings stay, as a frame is planned when its caller asks for rows; fewer rows that the caller has set stay too.
    """
    for name, most in BATCH.items():
        now = spark.conf.get(name)
        if not now.isdigit() or not 0 < int(now) <= int(most):
            spark.conf.set(name, most)


def spread(df: DataFrame) -> DataFrame:
    """A task per core for a table that fewer tasks read (one row group, few topic partitions).

    Tables with enough splits stay as they are, so large data is not shuffled for it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
