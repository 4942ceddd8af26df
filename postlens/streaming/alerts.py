"""Change-point alerts on a stream of window means, with state per platform."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from postlens.operators.changepoint import (
    ALERT_COLUMNS,
    ALERT_NAMES,
    ChartSettings,
    enough_posts,
    scan_windows,
    with_payload,
)
from postlens.operators.keyed import as_messages
from postlens.sources.sinks import KeyedTable, insert_ignore_into

STATE = "statistic double, last_alert timestamp"


def alerts_stream(windows: DataFrame, settings: ChartSettings = ChartSettings()) -> DataFrame:
    """Alerts of the resetting chart. The state is one number and one time per platform.

    A batch brings the windows that the watermark has closed since the last one, so windows
    reach the chart in time order. The state lives in the checkpoint and survives a restart.
    """

    def scan(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        statistic, last_alert = state.get if state.exists else (0.0, None)
        rows = pd.concat(list(batches))
        found, statistic, last_alert = scan_windows(rows, statistic, last_alert, settings)
        state.update((statistic, last_alert))
        yield pd.DataFrame(found, columns=ALERT_NAMES)

    return (
        enough_posts(windows, settings)
        .select("platform", "window_start", "window_end", "post_count", "avg_sentiment")
        .groupBy("platform")
        .applyInPandasWithState(
            scan, ALERT_COLUMNS, STATE, "append", GroupStateTimeout.NoTimeout
        )
    )


def start_alerts(
    windows: DataFrame,
    table: KeyedTable,
    message_path: str,
    checkpoint: str,
    settings: ChartSettings = ChartSettings(),
    **trigger,
) -> StreamingQuery:
    """Write alerts to the alert table and, as JSON, to the alert topic's folder.

    Alert ids come from platform and window, so a replayed batch adds nothing to the table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        alerts = with_payload(batch, settings).persist()
        insert_ignore_into(table, alerts)
        as_messages(alerts, "alert_id").write.mode("overwrite").json(
            f"{message_path}/batch={batch_id}"
        )
        alerts.unpersist()

    return (
        alerts_stream(windows, settings)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def alert_table(path: str) -> KeyedTable:
    return KeyedTable(path, ["alert_id"], time="detected_at")
