"""Registered queries: ``(spark, sf_dir) -> DataFrame`` for every operator key.

Each query reads the whole test tables of ``sf_dir`` (readings are derived from
``events`` and ``nation``), so its work grows with the data.  Timestamps leave
as wall-clock ``TIMESTAMP_NTZ`` so results do not depend on the session zone.
Round trips and streams write to fresh folders under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampType

from stationflow.functions.time import event_time
from stationflow.operators import feed, outliers, partials, quality, reports, stats, summary
from stationflow.operators.alerts import alert_records
from stationflow.operators.enrich import enrich_time
from stationflow.operators.windows import flatten_window, sliding_window_stats_batch
from stationflow.plans.storage import checkpoint_root, materialize, scratch_path
from stationflow.schema import ARCHIVE_COLUMNS, ENRICHED_COLUMNS, READING_COLUMNS
from stationflow.sinks.files import save_csv, save_parquet, save_table, save_text
from stationflow.sources.events import load_readings
from stationflow.sources.files import read_readings_csv
from stationflow.sources.topics import decode_payload, text_stream
from stationflow.sources.warehouse import (
    define_external_table,
    drop_table,
    ensure_database,
    scan,
)
from stationflow.streaming import queries as sq
from stationflow.streaming.upsert import read_latest

Query = Callable[[SparkSession, str], DataFrame]


def wall_clock_out(df: DataFrame) -> DataFrame:
    """Cast every zoned timestamp column to a wall-clock TIMESTAMP_NTZ."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def wire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_readings(spark, sf_dir)


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_time(wire(spark, sf_dir))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.daily_station_stats(enriched(spark, sf_dir), ordered=False)


def daily_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily columns that the day-over-day self-join reads, computed once and
    checkpointed: the join must not rescan the readings, nor the checkpoint hold more."""
    return materialize(daily(spark, sf_dir).select("station_id", "station_name", "date", "avg_temp"))


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings encoded as JSON payloads and decoded again (no topic in between)."""
    return decode_payload(feed.encode_payloads(wire(spark, sf_dir)))


# --- batch ------------------------------------------------------------------


def q_station_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = outliers.station_baseline(enriched(spark, sf_dir))
    return base.select("station_id", *[F.round(c, 6).alias(c) for c in ("mean_temp", "std_temp", "mean_wind", "std_wind")])


def with_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire readings with the parsed ``event_time`` (what the stream decoder adds)."""
    return wire(spark, sf_dir).withColumn("event_time", event_time("timestamp"))


def q_sliding_window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_window(sliding_window_stats_batch(with_event_time(spark, sf_dir)))


def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = enriched(spark, sf_dir)
    return summary.run_summary(
        stats.daily_station_stats(readings, ordered=False),
        outliers.sigma_outliers(readings),
    )


def q_refreshed_daily_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily statistics from the hourly partials, whose last day comes in a refresh of its own."""
    readings, path = enriched(spark, sf_dir), scratch_path(spark, "partials")
    last = readings.agg(F.max("date").alias("d")).first()["d"]
    partials.refresh_partials(spark, readings.where(F.col("date") < last), path)
    return partials.daily_of(partials.refresh_partials(spark, readings, path, [last]))


# --- round trips ------------------------------------------------------------


def q_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    save_csv(wire(spark, sf_dir), path)
    return read_readings_csv(spark, path)


def q_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "parquet")
    save_parquet(enriched(spark, sf_dir), path)
    return spark.read.parquet(path).select(*ENRICHED_COLUMNS)


SCRATCH_DATABASE = "stationflow_scratch"


def _scratch_table(spark: SparkSession, location: str) -> str:
    """A table name of its own for ``location``: concurrent runs never share a table."""
    ensure_database(spark, SCRATCH_DATABASE, f"{checkpoint_root(spark)}/stationflow/{SCRATCH_DATABASE}.db")
    return f"{SCRATCH_DATABASE}.readings_{location.rsplit('-', 1)[-1][:12]}"


def q_warehouse_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``saveAsTable`` at an explicit path, then a catalog scan; the entry is dropped again."""
    location = scratch_path(spark, "raw_readings")
    name = _scratch_table(spark, location)
    save_table(enriched(spark, sf_dir), name, path=location)
    found = scan(spark, name).select(*ENRICHED_COLUMNS)
    drop_table(spark, name)  # the scan holds the files, which stay
    return found


def q_hourly_pattern_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet files first, then an idempotent external-table definition over them,
    then the hourly report on the catalog table."""
    location = scratch_path(spark, "raw_readings_ext")
    readings = enriched(spark, sf_dir)
    save_parquet(readings, location)
    name = _scratch_table(spark, location)
    define_external_table(spark, name, readings.schema, location)
    found = reports.hourly_pattern(scan(spark, name))
    drop_table(spark, name)
    return found


# --- streams ----------------------------------------------------------------

#: Time slices of a stateful stream's feed; each is one micro-batch.
SLICES = 4
#: Readings sent once more at the feed's end, when their windows are long final.
LATE = 3


def write_feed(spark: SparkSession, sf_dir: str) -> str:
    """JSON-lines payload files, written as the input is split: for streams that keep no state."""
    path = scratch_path(spark, "feed")
    save_text(feed.encode_payloads(wire(spark, sf_dir)), path)
    return path


def write_sliced_feed(spark: SparkSession, sf_dir: str) -> str:
    """The feed in time order: ``SLICES`` folders of equal spans of time, and late readings.

    All slices are written by one job, each into as many files as its own readings
    fill, up to one per partition of the input.  The files' times follow the slices, and
    empty files bring every slice to the same number, so a source that takes the
    oldest files first, that many per trigger, sees one slice after the other.  The
    last file repeats the earliest readings, which the watermark must drop.
    """
    path = scratch_path(spark, "feed")
    readings = with_event_time(spark, sf_dir)
    span = readings.agg(F.min("event_time").alias("low"), F.max("event_time").alias("high")).first()
    # the first slice starts with the earliest reading, the last one holds the latest
    low, high = (F.unix_micros(F.lit(t)) for t in (span["low"], span["high"]))
    share = (F.unix_micros("event_time") - low) * SLICES / F.greatest(high - low, F.lit(1))
    files = readings.rdd.getNumPartitions()
    payloads = feed.encode_payloads(readings, READING_COLUMNS, F.least(F.floor(share), F.lit(SLICES - 1)).alias("slice"))
    dealt = payloads.repartition(SLICES * files, "slice", F.pmod(F.xxhash64("value"), F.lit(files)))
    dealt.write.partitionBy("slice").text(f"{path}/slices")
    late = readings.orderBy("event_time", "station_id").limit(LATE)
    save_text(feed.encode_payloads(late, READING_COLUMNS).coalesce(1), f"{path}/feed/part-{SLICES}")
    _order_slices(spark, path, files)
    return f"{path}/feed/*"


def _order_slices(spark: SparkSession, path: str, files: int) -> None:
    """Move the slices to ``feed``, fill each up to ``files`` files, and date them one after the other."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    feed_root = hadoop.Path(f"{path}/feed")
    fs = feed_root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    start = fs.getFileStatus(feed_root).getModificationTime() - 1000 * (SLICES + 1)
    for i in range(SLICES):
        source, target = hadoop.Path(f"{path}/slices/slice={i}"), hadoop.Path(f"{path}/feed/part-{i}")
        if not fs.exists(source):
            continue
        fs.rename(source, target)
        for extra in range(len(fs.listStatus(target)), files):
            fs.create(hadoop.Path(target, f"part-none-{extra}.txt")).close()
        for status in fs.listStatus(target):
            fs.setTimes(status.getPath(), start + 1000 * i, -1)


def _files_a_batch(spark: SparkSession, source: str) -> int:
    """Files of a slice of a sliced feed (the first slice holds the earliest reading); 1 for another feed."""
    return len(spark.read.text(f"{source[:-1]}part-0").inputFiles()) if source.endswith("/*") else 1


def _drain(start, spark: SparkSession, source: str, label: str) -> tuple[str, StreamingQuery]:
    """Run one streaming query over a feed (availableNow, a file or slice per micro-batch); its output and the query."""
    out = scratch_path(spark, f"{label}-out")
    query = start(
        decode_payload(text_stream(spark, source, max_files_per_trigger=_files_a_batch(spark, source))),
        out,
        scratch_path(spark, f"{label}-ckpt"),
        {"availableNow": True},
        # a unique name: two runs may be active in one session at once
        name=f"{label}_{out.rsplit('-', 1)[-1][:12]}",
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return out, query


def q_alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = _drain(sq.start_alerts, spark, write_feed(spark, sf_dir), "alerts")
    return spark.read.parquet(out)


def q_sliding_window_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = _drain(sq.start_window_updates, spark, write_sliced_feed(spark, sf_dir), "windows")
    return flatten_window(read_latest(spark, out, sq.WINDOW_KEYS))


def q_closed_windows_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = _drain(sq.start_closed_windows, spark, write_sliced_feed(spark, sf_dir), "closed")
    return flatten_window(spark.read.parquet(out))


def q_raw_archive_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, _ = _drain(sq.start_archive, spark, write_feed(spark, sf_dir), "archive")
    return wall_clock_out(spark.read.parquet(out).select(*ARCHIVE_COLUMNS))


# --- registry ---------------------------------------------------------------


def queries() -> dict[str, Query]:
    e = enriched
    return {
        "enriched_readings": lambda s, d: e(s, d),
        "daily_station_stats": lambda s, d: stats.daily_station_stats(e(s, d)),
        "daily_station_stats_compact": lambda s, d: stats.daily_station_stats_compact(e(s, d)),
        "monthly_stats": lambda s, d: stats.monthly_stats(e(s, d)),
        "station_ranking": lambda s, d: stats.station_ranking(e(s, d)),
        "station_baseline": q_station_baseline,
        "sigma_outliers": lambda s, d: outliers.sigma_outliers(e(s, d)),
        "hourly_profile": lambda s, d: stats.hourly_profile(e(s, d)),
        "station_extremes": lambda s, d: stats.station_extremes(e(s, d)),
        "gusty_days": lambda s, d: stats.gusty_days(e(s, d)),
        "hottest_days": lambda s, d: reports.hottest_days(daily(s, d)),
        "monthly_trend": lambda s, d: reports.monthly_trend(e(s, d)),
        "anomaly_leaderboard": lambda s, d: reports.anomaly_leaderboard(daily(s, d)),
        "rainy_days": lambda s, d: reports.rainy_days(daily(s, d)),
        "station_conditions": lambda s, d: reports.station_conditions(daily(s, d)),
        "hourly_pattern_table": q_hourly_pattern_table,
        "day_over_day_change": lambda s, d: reports.day_over_day_change(daily_means(s, d)),
        "alerts": lambda s, d: alert_records(wire(s, d)),
        "sliding_window_stats": q_sliding_window_stats,
        "feed_summary": lambda s, d: feed.feed_summary(wire(s, d)),
        "run_summary": q_run_summary,
        "contract_report": lambda s, d: quality.contract_report(wire(s, d)),
        "anomaly_rate": lambda s, d: quality.anomaly_rate(e(s, d)),
        "diurnal_contrast": lambda s, d: quality.diurnal_contrast(e(s, d)),
        "cadence_gaps": lambda s, d: quality.cadence_gaps(e(s, d)),
        "refreshed_daily_stats": q_refreshed_daily_stats,
        "csv_roundtrip": q_csv_roundtrip,
        "parquet_roundtrip": q_parquet_roundtrip,
        "warehouse_roundtrip": q_warehouse_roundtrip,
        "decoded_payloads": lambda s, d: wall_clock_out(decoded(s, d)),
        "encoded_payloads": lambda s, d: feed.encode_payloads(wire(s, d)),
        "alerts_stream": q_alerts_stream,
        "sliding_window_stream": q_sliding_window_stream,
        "closed_windows_stream": q_closed_windows_stream,
        "raw_archive_stream": q_raw_archive_stream,
    }


__all__ = ["queries", "wall_clock_out", "READING_COLUMNS"]
