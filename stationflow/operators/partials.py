"""One mergeable table behind every statistic: sums of each station, day and hour.

Readings are summed up once, per (station, day, hour), into parts that add up further:
exact sums and sums of squares as split integers, counts and extremes.  Daily, monthly,
hourly and per-station statistics, the outliers' baseline and the gusty days all follow
from these rows, equal to those computed from the readings.  The table is partitioned by
date, so a new or corrected day is read and summed up alone; the statistics are then
aggregates of at most 24 rows per station-day, whatever the rate of the readings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.measures import agg_exprs, exact_mean_sql, merged_stddev_sql, parts_sql, rounded, square_parts_sql, total_sql
from stationflow.operators.stats import COUNT_ALL, COUNT_ANOMALIES, DAILY_KEYS
from stationflow.schema import GUST_THRESHOLD

KEYS = ["station_id", "station_name", "date", "hour"]
#: Summed columns by the short name of their parts.
SUMS = {"t": "temperature_c", "h": "humidity_pct", "p": "pressure_hpa", "w": "wind_speed_kmh", "r": "precipitation_mm"}
#: Those whose deviation is reported as well.
SQUARES = ("t", "w")


def _part_exprs() -> dict[str, str]:
    exprs = {"readings": COUNT_ALL, "anomalies": COUNT_ANOMALIES}
    for name, column in SUMS.items():
        exprs |= {f"{name}_{part}": sql for part, sql in parts_sql(column).items()}
        exprs |= {f"{name}_min": f"min({column})", f"{name}_max": f"max({column})"}
    for name in SQUARES:
        exprs |= {f"{name}_{part}": sql for part, sql in square_parts_sql(SUMS[name]).items()}
        # for values that aren't whole units: the mean and the squared distance from it, of this row alone
        exprs |= {f"{name}_avg": exact_mean_sql(SUMS[name]), f"{name}_m2": f"var_pop({SUMS[name]}) * count({SUMS[name]})"}
    gust = f"wind_speed_kmh > {GUST_THRESHOLD}D"
    exprs |= {"gusts": f"count_if(coalesce({gust}, false))", "gust_max": f"max(CASE WHEN {gust} THEN wind_speed_kmh END)"}
    return exprs


def hourly_partials(readings: DataFrame) -> DataFrame:
    """The table's rows of enriched ``readings``: a partial aggregate, no reading is shuffled."""
    return readings.groupBy(*KEYS).agg(*agg_exprs(_part_exprs()))


def refresh_partials(spark: SparkSession, readings: DataFrame, path: str, dates: list | None = None) -> DataFrame:
    """Write the partials of ``readings`` to the table at ``path``, replacing whole dates, and return the table.

    ``dates`` limits the refresh to those days (of a table partitioned by date only they
    are read; None stands for readings without a date); other days' files stay as they
    are.  Without it every day that ``readings`` has is replaced.
    """
    writer = partials_of_days(readings, dates).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date").parquet(path)
    return read_partials(spark, path)


def partials_of_days(readings: DataFrame, dates: list | None = None) -> DataFrame:
    """Partials of the readings of ``dates`` (all without it), one task's rows per date: a few dozen a station."""
    rows = readings
    if dates is not None:
        chosen = F.col("date").isin(*(d for d in dates if d is not None))
        rows = readings.where(chosen | F.col("date").isNull() if None in dates else chosen)
    return hourly_partials(rows).repartition("date")


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.withColumn("date", F.col("date").cast("date"))


def _total(name: str) -> str:
    return total_sql(*(f"sum({name}_{part})" for part in ("hi", "lo", "rest")))


def _mean(name: str) -> str:
    return f"({_total(name)} / sum({name}_n))"


def _extremes() -> dict[str, str]:
    return {"min_temp": rounded("min(t_min)"), "max_temp": rounded("max(t_max)")}


def daily_of(partials: DataFrame) -> DataFrame:
    """The daily statistics per station."""
    return partials.groupBy(*DAILY_KEYS).agg(
        *agg_exprs(
            {"avg_temp": rounded(_mean("t"))}
            | _extremes()
            | {
                "avg_humidity": rounded(_mean("h")),
                "avg_pressure": rounded(_mean("p")),
                "avg_wind_speed": rounded(_mean("w")),
                "total_precipitation": rounded(_total("r")),
                "num_readings": "sum(readings)",
                "anomaly_count": "sum(anomalies)",
            }
        )
    )


def monthly_of(partials: DataFrame) -> DataFrame:
    """The statistics per calendar month; the monthly trend is a projection of them."""
    return partials.groupBy(F.month("date").alias("month")).agg(
        *agg_exprs(
            {"avg_temp": rounded(_mean("t"))}
            | _extremes()
            | {
                "avg_humidity": rounded(_mean("h")),
                "total_precipitation": rounded(_total("r")),
                "num_readings": "sum(readings)",
            }
        )
    )


def monthly_trend_of(partials: DataFrame) -> DataFrame:
    return monthly_of(partials).select(
        "month", "avg_temp", "min_temp", "max_temp", F.col("num_readings").alias("total_readings")
    ).orderBy("month")


def stations_of(partials: DataFrame) -> DataFrame:
    """What ``stats.ranking_of`` and ``stats.extremes_of`` report of a station."""
    return partials.groupBy("station_id", "station_name").agg(
        *agg_exprs(
            {
                "avg_temp": rounded(_mean("t")),
                "avg_wind": rounded(_mean("w")),
                "total_precip": rounded(_total("r")),
                "record_low": rounded("min(t_min)"),
                "record_high": rounded("max(t_max)"),
                "stddev_temp": rounded(merged_stddev_sql("t")),
            }
        )
    )


def baseline_of(partials: DataFrame) -> DataFrame:
    """The outliers' baseline: unrounded means and deviations per station."""
    return partials.groupBy("station_id").agg(
        *agg_exprs(
            {
                "mean_temp": _mean("t"),
                "std_temp": merged_stddev_sql("t"),
                "mean_wind": _mean("w"),
                "std_wind": merged_stddev_sql("w"),
            }
        )
    )


def hourly_of(partials: DataFrame) -> DataFrame:
    """Means per hour of day over all stations."""
    means = {"avg_temp": rounded(_mean("t")), "avg_humidity": rounded(_mean("h")), "avg_wind": rounded(_mean("w"))}
    return partials.groupBy("hour").agg(*agg_exprs(means))


def gusty_of(partials: DataFrame) -> DataFrame:
    """Days with gusts per station name: peak and count."""
    own = partials.where("gusts > 0").groupBy("station_name", "date")
    return own.agg(*agg_exprs({"max_gust": rounded("max(gust_max)", 1), "high_wind_readings": "sum(gusts)"}))
