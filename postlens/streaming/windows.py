"""Windowed sentiment over a stream of scored posts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from postlens.operators.filters import not_spam
from postlens.sources.sinks import KeyedTable, upsert_into


def stream_windows(
    posts: DataFrame, width: str = "15 minutes", delay: str = "10 minutes", slide: str | None = None
) -> DataFrame:
    """Window means per platform, emitted once the watermark has passed the window's end.

    Tumbling by default; with a slide of one minute it gives the overlapping windows that a
    check every minute would see. Posts later than the delay are dropped and counted.
    """
    return (
        not_spam(posts)
        .withWatermark("created_at", delay)
        .groupBy(F.window("created_at", width, slide).alias("w"), "platform")
        .agg(
            F.count(F.lit(1)).alias("post_count"),
            F.avg("sentiment_score").alias("avg_sentiment"),
            F.stddev_samp("sentiment_score").alias("stddev_sentiment"),
        )
        .select(
            "platform",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "post_count",
            "avg_sentiment",
            "stddev_sentiment",
        )
    )


WINDOW_KEY = ["platform", "window_start", "window_end"]


def window_table(path: str) -> KeyedTable:
    return KeyedTable(path, WINDOW_KEY, time="window_start")


def run_to_end(stream: DataFrame, table: KeyedTable, checkpoint: str) -> StreamingQuery:
    """Process all data present now and store every window, those still open at its end as well.

    A window is stored when it changes and replaced when it changes again, so a later run goes on from there.
    """
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: upsert_into(table, batch))
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped as later than the watermark, over the progress reports still kept."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def run_available(stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Process all data present now, write it to path and stop."""
    query = (
        stream.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
    query.awaitTermination()
    return query
