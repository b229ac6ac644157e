"""Batch job: readings CSV -> warehouse tables -> statistics, outliers, summary.

    python -m stationflow.jobs.batch <input_csv> <output_base> [--database weather_db]
    ... --new-days   (the input holds new or corrected days of an earlier run: only those are redone)
    ... --versioned  (outputs are switched when they are whole: readers are never disturbed)

Plan for scale: the CSV is parsed exactly once, into the ``raw_readings`` table
(Parquet, partitioned by ``date``) in the shared warehouse.  Every later output
scans that table, reading only the columns it needs, so no step re-parses
text, nothing has to fit in executor memory (no cache of the raw data), and a
lost executor costs a re-read of the written table, not of the source.
"""

from __future__ import annotations

import argparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stationflow.operators import outliers, partials, stats
from stationflow.operators.partials import partials_of_days, refresh_partials
from stationflow.operators.summary import run_summary
from stationflow.plans.storage import materialize
from stationflow.schema import DATABASE
from stationflow.session import build_session
from stationflow.sinks.files import save_parquet
from stationflow.sinks.versions import read_current, save_version
from stationflow.sources.files import read_readings_csv
from stationflow.sources.warehouse import (
    define_external_table,
    define_version_table,
    drop_table,
    ensure_database,
    scan,
)

OUTPUTS = (
    "daily_aggregations",
    "monthly_aggregations",
    "station_rankings",
    "anomalies",
    "hourly_patterns",
    "daily_stats_compact",
    "station_extremes",
    "gusty_days",
)


def _write_table(
    spark: SparkSession,
    df: DataFrame,
    name: str,
    path: str,
    partition_by: list[str] | None = None,
    dynamic: bool = False,
    versioned: bool = False,
) -> DataFrame:
    """Write ``df`` at ``path``, define the external table ``name`` over it and read it back.

    The data is written once, outside the catalog; what fails there fails the
    job.  A catalog that refuses the definition is reported, and the run goes on
    with the files.  An older table of that name is forgotten first; a ``versioned``
    one is switched to the new files.
    """
    if versioned:
        save_version(df, path, partition_by[0] if partition_by else None, keep_others=dynamic)
    else:
        save_parquet(df, path, partition_by=partition_by, dynamic=dynamic)
    try:
        ensure_database(spark, name.split(".")[0])
        if versioned:
            define_version_table(spark, name, path)
            return read_current(spark, path)
        drop_table(spark, name)
        define_external_table(spark, name, df.schema, path, partition_by)
        return scan(spark, name)
    except AnalysisException as refused:
        print(f"Table {name} not defined ({refused.getCondition()}); using files at {path}")
        return read_current(spark, path)


def run_batch(
    spark: SparkSession,
    readings: DataFrame,
    output_base: str,
    database: str = DATABASE,
    cluster_by_date: bool = True,
    new_days: bool = False,
    versioned: bool = False,
) -> DataFrame:
    """Write the raw and daily tables and every output in ``OUTPUTS``; return the run summary.

    ``cluster_by_date`` range-partitions the readings on (date, station,
    timestamp) before the date-partitioned write: one shuffle at ingest, after
    which each task writes few date folders (files ~ tasks + dates instead of
    tasks x dates when the input is not grouped by time), and a hot date is
    split over many tasks by the station/time tie-breakers.

    Statistics come from the hourly partials (``operators.partials``): one scan of the
    readings.  With ``new_days`` the readings replace the days they hold in the output
    of an earlier run: those days' files and partials alone are written anew.

    With ``versioned`` every output gets a new version that is put in force when it is
    whole (``sinks.versions``): a reader during the run sees the old rows or the new,
    and a failed run leaves the old.  Read such outputs with ``versions.read_current``.
    """
    if cluster_by_date:
        readings = readings.repartitionByRange("date", "station_id", "timestamp")
    base = output_base.rstrip("/")
    dates = None
    if new_days:
        # one row per day of the new readings: days, not readings, reach the driver
        dates = [r["date"] for r in readings.select("date").distinct().collect()]
    save = save_version if versioned else save_parquet
    raw = _write_table(
        spark, readings, f"{database}.raw_readings", f"{base}/warehouse/raw_readings", ["date"], new_days, versioned
    )
    hourly = f"{base}/warehouse/hourly_partials"
    if versioned:
        save_version(partials_of_days(raw, dates), hourly, "date", keep_others=new_days)
        hours = read_current(spark, hourly)
    else:
        hours = refresh_partials(spark, raw, hourly, dates)
    daily = _write_table(
        spark,
        partials.daily_of(hours),
        f"{database}.daily_stats",
        f"{base}/warehouse/daily_stats",
        versioned=versioned,
    )
    save(daily, f"{base}/daily_aggregations")
    save(stats.compact_of_daily(daily), f"{base}/daily_stats_compact")
    save(partials.monthly_of(hours), f"{base}/monthly_aggregations")
    stations = materialize(partials.stations_of(hours))
    save(stats.ranking_of(stations), f"{base}/station_rankings")
    save(stats.extremes_of(stations), f"{base}/station_extremes")
    baseline = materialize(partials.baseline_of(hours))
    save(outliers.sigma_outliers(raw, baseline=baseline), f"{base}/anomalies")
    save(partials.hourly_of(hours).orderBy("hour"), f"{base}/hourly_patterns")
    save(partials.gusty_of(hours).orderBy(F.desc("max_gust")), f"{base}/gusty_days")

    return run_summary(daily, read_current(spark, f"{base}/anomalies"))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("input", help="readings CSV file or folder (header row, columns in any order)")
    parser.add_argument("output", help="output base folder (shared storage on a cluster)")
    parser.add_argument("--database", default=DATABASE)
    parser.add_argument("--master", default=None)
    parser.add_argument("--hive", action="store_true", help="persistent Hive metastore for the tables")
    parser.add_argument("--preview", type=int, default=0, help="print the first N rows of each output")
    parser.add_argument("--keep-input-order", action="store_true", help="skip the shuffle that clusters files by date")
    parser.add_argument("--new-days", action="store_true", help="replace only the days the input holds in an earlier run's output")
    parser.add_argument("--versioned", action="store_true", help="write new versions of the outputs and switch to them when whole")
    args = parser.parse_args(argv)

    spark = build_session(args.master, app="stationflow-batch", hive=args.hive)
    bad = Observation("bad_cells")
    readings = read_readings_csv(spark, args.input, bad_cells=bad)
    summary = run_batch(
        spark, readings, args.output, args.database, not args.keep_input_order, args.new_days, args.versioned
    )
    if args.preview:
        print(f"=== {args.database}.raw_readings ===")
        read_current(spark, f"{args.output.rstrip('/')}/warehouse/raw_readings").printSchema()
        for name in OUTPUTS:
            print(f"=== {name} ===")
            read_current(spark, f"{args.output.rstrip('/')}/{name}").show(args.preview, truncate=False)
    summary.show(truncate=False)
    print(f"Cells that didn't hold their type: { {k: n for k, n in bad.get.items() if n} or 'none' }")
    print(f"Output directory: {args.output}")
    spark.stop()


__all__ = ["run_batch", "OUTPUTS"]

if __name__ == "__main__":
    main()
