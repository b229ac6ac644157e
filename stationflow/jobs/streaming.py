"""Streaming job: one decoded reading stream, three concurrent queries.

    python -m stationflow.jobs.streaming <output_base> --kafka host:9092 [--topic weather-raw]
    python -m stationflow.jobs.streaming <output_base> --files <folder of JSON lines>
    ... --available-now   (drain what is there and stop: backfills, catch-up runs)
    ... --compact-every 50   (merge the committed window batches every 50 batches)
    python -m stationflow.jobs.streaming <output_base> --compact-windows   (merge them now and stop)

A trigger takes at most --max-offsets or --max-files, so the first batch from the
earliest offset is a bounded one, not the whole backlog.


* ``weather_alerts``  - stateless alerts, append, every 10 s, to Parquet (--alerts-to-console previews them instead)
* ``windowed_stats``  - 5-minute/1-minute windows per station, update mode, every 30 s,
  upserted per micro-batch under ``<output_base>/windows``
* ``raw_archive``     - every decoded row appended to Parquet by event date, every 30 s
* ``closed_windows``  - (``--closed-windows``) each window written once, final, when the
  watermark passes its end: the append-only window history; the update-mode
  folders above are the live view and can be pruned once their windows closed

Progress of every batch and the end of every query are stored under ``<output_base>/events``
(``monitor.read_events``).  When one query ends or fails, the others are stopped and the
job ends, with an error if it failed.

Each query keeps its own checkpoint under ``<output_base>/checkpoints``, so a
restart resumes from the stored offsets and state instead of replaying the topic.
Window state lives in the RocksDB state store (off-heap, spills to local disk,
snapshotted to the checkpoint), and the 10-minute watermark bounds it.  The
number of state partitions is ``spark.sql.shuffle.partitions`` at the first
start and is fixed by the checkpoint afterwards: size it for the target rate
before the first run.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stationflow.session import build_session
from stationflow.sources.topics import DEFAULT_TOPIC, decode_payload, kafka_stream, text_stream
from stationflow.streaming import queries as sq
from stationflow.streaming.monitor import EventLog, wait_for_any
from stationflow.streaming.upsert import committed_upto, compact


def start_all(
    spark: SparkSession,
    parsed: DataFrame,
    output_base: str,
    alerts_to_files: bool = True,
    windows_to_files: bool = True,
    alert_trigger: dict | None = None,
    window_trigger: dict | None = None,
    archive_trigger: dict | None = None,
    closed_windows: bool = False,
    compact_every: int | None = None,
) -> list[StreamingQuery]:
    base = output_base.rstrip("/")
    ck = f"{base}/checkpoints"
    extra = []
    if closed_windows:
        extra.append(
            sq.start_closed_windows(
                parsed, f"{base}/windows_closed", f"{ck}/windows_closed", window_trigger or {"processingTime": "30 seconds"}
            )
        )
    return extra + [
        sq.start_alerts(
            parsed,
            f"{base}/alerts" if alerts_to_files else None,
            f"{ck}/alerts",
            alert_trigger or {"processingTime": "10 seconds"},
        ),
        sq.start_window_updates(
            parsed,
            f"{base}/windows" if windows_to_files else None,
            f"{ck}/windows",
            window_trigger or {"processingTime": "30 seconds"},
            compact_every=compact_every,
        ),
        sq.start_archive(
            parsed, f"{base}/raw_parquet", f"{ck}/raw", archive_trigger or {"processingTime": "30 seconds"}
        ),
    ]


def compact_windows(spark: SparkSession, output_base: str) -> int:
    """Merge the window batches a run under ``output_base`` has committed; the last one's id."""
    base = output_base.rstrip("/")
    upto = committed_upto(spark, f"{base}/checkpoints/windows")
    if upto >= 0:
        compact(spark, f"{base}/windows", sq.WINDOW_KEYS, upto)
    return upto


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("output", help="output base folder (shared storage on a cluster)")
    src = parser.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--files", help="folder of JSON-lines payload files")
    src.add_argument("--compact-windows", action="store_true", help="merge the committed window batches and stop")
    parser.add_argument("--compact-every", type=int, default=None, help="merge them every so many batches while running")
    parser.add_argument("--topic", default=DEFAULT_TOPIC)
    parser.add_argument("--alerts-to-console", action="store_true", help="preview the alerts instead of writing them")
    parser.add_argument("--max-offsets", type=int, default=5_000_000, help="messages per trigger, over all partitions")
    parser.add_argument("--min-partitions", type=int, default=None, help="tasks per trigger at least")
    parser.add_argument("--max-files", type=int, default=200, help="files per trigger")
    parser.add_argument("--windows-to-console", action="store_true")
    parser.add_argument("--closed-windows", action="store_true", help="also append final windows to Parquet")
    parser.add_argument(
        "--available-now", action="store_true", help="process what is there in bounded batches, then stop"
    )
    parser.add_argument("--master", default=None)
    args = parser.parse_args(argv)

    spark = build_session(args.master, app="stationflow-streaming", tasks_per_core=1)
    if args.compact_windows:
        print(f"Window batches merged up to {compact_windows(spark, args.output)}")
        spark.stop()
        return
    if args.kafka:
        raw = kafka_stream(
            spark,
            args.kafka,
            args.topic,
            max_offsets_per_trigger=args.max_offsets,
            min_partitions=args.min_partitions,
        )
    else:
        raw = text_stream(spark, args.files, max_files_per_trigger=args.max_files)
    spark.streams.addListener(EventLog(spark, f"{args.output.rstrip('/')}/events"))
    once = {"availableNow": True} if args.available_now else None
    queries = start_all(
        spark,
        decode_payload(raw),
        args.output,
        alerts_to_files=not args.alerts_to_console,
        windows_to_files=not args.windows_to_console,
        alert_trigger=once,
        window_trigger=once,
        archive_trigger=once,
        closed_windows=args.closed_windows,
        compact_every=args.compact_every,
    )
    if args.available_now:
        for q in queries:
            q.awaitTermination()
        failed = [q.name for q in queries if q.exception() is not None]
        spark.stop()
        if failed:
            raise SystemExit(f"queries failed: {failed}")
    else:
        ended = wait_for_any(spark, queries)
        failure = ended.exception()
        spark.stop()
        if failure is not None:
            raise SystemExit(f"query {ended.name} failed: {failure}")


if __name__ == "__main__":
    main()
