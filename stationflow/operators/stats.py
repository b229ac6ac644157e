"""Batch statistics over enriched readings: daily, monthly, hourly, per station.

All are one ``groupBy().agg()``: Catalyst plans a partial (map-side) hash
aggregate, a shuffle of the partial rows on the group key and a final
aggregate, so a station holding a third of all rows costs one partial row per
task, not a hot reducer.  ``ordered=True`` adds the reference's presentation
order; jobs that store the result pass ``ordered=False`` to skip the global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.measures import agg_exprs, exact_stddev_sql, rounded, rounded_mean, rounded_sum
from stationflow.schema import GUST_THRESHOLD

DAILY_KEYS = ["station_id", "station_name", "date"]
COUNT_ALL = "count(1)"
COUNT_ANOMALIES = "count_if(coalesce(is_anomaly, false))"


def _order(df: DataFrame, ordered: bool, *cols) -> DataFrame:
    return df.orderBy(*cols) if ordered else df


def daily_station_stats(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Per (station, day): rounded means/extremes, rain total, counts."""
    out = df.groupBy(*DAILY_KEYS).agg(
        *agg_exprs(
            {
                "avg_temp": rounded_mean("temperature_c"),
                "min_temp": rounded("min(temperature_c)"),
                "max_temp": rounded("max(temperature_c)"),
                "avg_humidity": rounded_mean("humidity_pct"),
                "avg_pressure": rounded_mean("pressure_hpa"),
                "avg_wind_speed": rounded_mean("wind_speed_kmh"),
                "total_precipitation": rounded_sum("precipitation_mm"),
                "num_readings": COUNT_ALL,
                "anomaly_count": COUNT_ANOMALIES,
            }
        )
    )
    return _order(out, ordered, "station_id", "date")


def compact_of_daily(daily: DataFrame) -> DataFrame:
    """The compact daily table as a projection of the full one."""
    return daily.select(
        *DAILY_KEYS,
        "avg_temp",
        "min_temp",
        "max_temp",
        "avg_humidity",
        F.col("avg_wind_speed").alias("avg_wind"),
        F.col("total_precipitation").alias("total_precip"),
        F.col("num_readings").alias("readings"),
    )


def daily_station_stats_compact(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Per (station, day) without pressure or anomaly count (the Scala variant)."""
    return _order(compact_of_daily(daily_station_stats(df, ordered=False)), ordered, "station_id", "date")


def monthly_stats(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Per calendar month over all stations and years (month ignores the year)."""
    out = df.groupBy("month").agg(
        *agg_exprs(
            {
                "avg_temp": rounded_mean("temperature_c"),
                "min_temp": rounded("min(temperature_c)"),
                "max_temp": rounded("max(temperature_c)"),
                "avg_humidity": rounded_mean("humidity_pct"),
                "total_precipitation": rounded_sum("precipitation_mm"),
                "num_readings": COUNT_ALL,
            }
        )
    )
    return _order(out, ordered, "month")


def station_statistics(df: DataFrame) -> DataFrame:
    """Everything the ranking and the extremes report of a station, in one pass."""
    return df.groupBy("station_id", "station_name").agg(
        *agg_exprs(
            {
                "avg_temp": rounded_mean("temperature_c"),
                "avg_wind": rounded_mean("wind_speed_kmh"),
                "total_precip": rounded_sum("precipitation_mm"),
                "record_low": rounded("min(temperature_c)"),
                "record_high": rounded("max(temperature_c)"),
                "stddev_temp": rounded(exact_stddev_sql("temperature_c")),
            }
        )
    )


def ranking_of(stations: DataFrame, ordered: bool = True) -> DataFrame:
    """The ranking, from :func:`station_statistics`; ties by station."""
    out = stations.select("station_id", "station_name", "avg_temp", "avg_wind", "total_precip")
    return _order(out, ordered, F.desc("avg_temp"), "station_id", "station_name")


def extremes_of(stations: DataFrame, ordered: bool = True) -> DataFrame:
    """The extremes, from :func:`station_statistics`; ties by station."""
    mean = F.col("avg_temp").alias("mean_temp")
    out = stations.select("station_id", "station_name", "record_low", "record_high", mean, "stddev_temp")
    return _order(out, ordered, F.desc("record_high"), "station_id", "station_name")


def station_ranking(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Stations by mean temperature, warmest first (no rank column)."""
    return ranking_of(station_statistics(df), ordered)


def hourly_profile(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Diurnal cycle: means per hour of day over all stations."""
    out = df.groupBy("hour").agg(
        *agg_exprs(
            {
                "avg_temp": rounded_mean("temperature_c"),
                "avg_humidity": rounded_mean("humidity_pct"),
                "avg_wind": rounded_mean("wind_speed_kmh"),
            }
        )
    )
    return _order(out, ordered, "hour")


def station_extremes(df: DataFrame, ordered: bool = True) -> DataFrame:
    """Record low/high, mean and sample standard deviation of temperature per station."""
    return extremes_of(station_statistics(df), ordered)


def gusty_days(df: DataFrame, threshold: float = GUST_THRESHOLD, ordered: bool = True) -> DataFrame:
    """(station_name, day) with readings above ``threshold`` km/h: peak gust and count."""
    out = (
        df.where(F.col("wind_speed_kmh") > threshold)
        .groupBy("station_name", "date")
        .agg(*agg_exprs({"max_gust": rounded("max(wind_speed_kmh)", 1), "high_wind_readings": COUNT_ALL}))
    )
    return _order(out, ordered, F.desc("max_gust"))
