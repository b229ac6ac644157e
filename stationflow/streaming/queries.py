"""The streaming job's queries, each a function of the decoded reading stream.

Every query has its own checkpoint (offsets, state, sink log) under a shared
folder, so a restart resumes where it stopped instead of replaying the topic.
Triggers are passed through: ``{"processingTime": "10 seconds"}`` in the job,
``{"availableNow": True}`` to drain what is there and stop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stationflow.operators.alerts import alert_records
from stationflow.operators.windows import sliding_window_stats, sliding_window_stats_chained
from stationflow.schema import ALERTS_QUERY, ARCHIVE_COLUMNS, ARCHIVE_QUERY, WINDOWS_QUERY
from stationflow.streaming.upsert import batch_writer

WINDOW_KEYS = ["window", "station_id", "station_name"]


def _start(writer, name: str, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    writer = writer.queryName(name).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_alerts(
    parsed: DataFrame,
    path: str | None,
    checkpoint: str,
    trigger: dict | None = None,
    name: str = ALERTS_QUERY,
) -> StreamingQuery:
    """Stateless alerts, append mode: to Parquet at ``path``.

    Without a path they go to the console, a preview: it passes every row of a
    batch through the driver and prints the first 20.
    """
    alerts = alert_records(parsed)
    writer = alerts.writeStream.outputMode("append")
    if path:
        writer = writer.format("parquet").option("path", path)
    else:
        writer = writer.format("console").option("truncate", False)
    return _start(writer, name, checkpoint, trigger)


def start_window_updates(
    parsed: DataFrame,
    path: str | None,
    checkpoint: str,
    trigger: dict | None = None,
    name: str = WINDOWS_QUERY,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Sliding-window stats in update mode: every batch writes the windows it changed
    to ``path`` (read the current values with ``upsert.read_latest(spark, path,
    WINDOW_KEYS)``).  Every ``compact_every`` batches the committed ones are merged;
    ``upsert.compact`` does so from outside.  Without a path the console previews them."""
    windows = sliding_window_stats(parsed)
    writer = windows.writeStream.outputMode("update")
    if path:
        writer = writer.foreachBatch(batch_writer(path, WINDOW_KEYS, compact_every))
    else:
        writer = writer.format("console").option("truncate", False)
    return _start(writer, name, checkpoint, trigger)


def start_closed_windows(
    parsed: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str = "closed_windows",
    panes: bool = True,
) -> StreamingQuery:
    """Sliding-window stats in append mode: each window is written once, when the
    watermark passes its end, and its state is dropped.

    With ``panes`` readings are kept per minute first and only closed minutes are
    gathered into windows: a reading touches one row of state, not five.
    """
    windows = sliding_window_stats_chained(parsed) if panes else sliding_window_stats(parsed)
    writer = windows.writeStream.outputMode("append").format("parquet").option("path", path)
    return _start(writer, name, checkpoint, trigger)


def start_archive(
    parsed: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    name: str = ARCHIVE_QUERY,
    partition_by_date: bool = True,
) -> StreamingQuery:
    """Every decoded row (garbage rows included, as all-null rows) appended to Parquet.

    A batch writes its own ``batch_id=N`` folder, whole and anew if it is replayed, and
    inside it one folder per event date, so later batch reads prune by day.  Its rows
    are rebalanced by date: small dates share a task and a date that holds much of
    the batch, one hour of one station too, is cut into files by its bytes.
    """
    rows = parsed.select(*ARCHIVE_COLUMNS)

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch_id={batch_id}"
        if partition_by_date:
            dated = batch.withColumn("event_date", F.to_date("event_time")).hint("rebalance", "event_date")
            dated.write.mode("overwrite").partitionBy("event_date").parquet(folder)
        else:
            batch.hint("rebalance").write.mode("overwrite").parquet(folder)

    return _start(rows.writeStream.outputMode("append").foreachBatch(write), name, checkpoint, trigger)
