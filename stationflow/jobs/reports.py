"""Warehouse reports over the tables the batch job wrote.

    python -m stationflow.jobs.reports <output> [--database weather_db | --base <batch output>] [--preview N]

Runs the seven reports (top-5 hottest days, monthly trend, anomaly
leaderboard, rainy days, station conditions, hourly pattern, day-over-day
change) on ``raw_readings`` / ``daily_stats`` and writes each one whole as
Parquet under ``<output>``.  ``--base`` reads the files that run of the batch
job wrote, whatever an older catalog entry says.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from stationflow.operators import reports
from stationflow.schema import DATABASE
from stationflow.session import build_session
from stationflow.sinks.files import save_parquet
from stationflow.sinks.versions import read_current
from stationflow.sources.warehouse import scan


def _table(spark: SparkSession, name: str, base: str | None, folder: str) -> DataFrame:
    """The files a batch run wrote under ``base``, or without one the catalog table."""
    if base:
        return read_current(spark, f"{base.rstrip('/')}/warehouse/{folder}")
    return scan(spark, name)


def all_reports(spark: SparkSession, database: str = DATABASE, base: str | None = None) -> dict[str, DataFrame]:
    raw = _table(spark, f"{database}.raw_readings", base, "raw_readings")
    daily = _table(spark, f"{database}.daily_stats", base, "daily_stats")
    return {
        "hottest_days": reports.hottest_days(daily),
        "monthly_trend": reports.monthly_trend(raw),
        "anomaly_leaderboard": reports.anomaly_leaderboard(daily),
        "rainy_days": reports.rainy_days(daily),
        "station_conditions": reports.station_conditions(daily),
        "hourly_pattern": reports.hourly_pattern(raw),
        "day_over_day_change": reports.day_over_day_change(daily),
    }


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("out", help="write each report as Parquet under this folder")
    parser.add_argument("--database", default=DATABASE)
    parser.add_argument("--base", default=None, help="batch job output folder to read instead of the catalog")
    parser.add_argument("--preview", type=int, default=0, help="also print the first N rows of each report")
    parser.add_argument("--master", default=None)
    parser.add_argument("--hive", action="store_true", help="persistent Hive metastore for the tables")
    args = parser.parse_args(argv)

    spark = build_session(args.master, app="stationflow-reports", hive=args.hive)
    for name, df in all_reports(spark, args.database, args.base).items():
        save_parquet(df, f"{args.out.rstrip('/')}/{name}")
        if args.preview:
            print(f"=== {name} ===")
            spark.read.parquet(f"{args.out.rstrip('/')}/{name}").show(args.preview, truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()
