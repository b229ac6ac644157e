"""The warehouse reports, over the ``daily_stats`` and ``raw_readings`` tables.

Top-k reports break ties on ``station_name, date`` so that LIMIT is
deterministic; ``orderBy().limit(k)`` plans as TakeOrderedAndProject, a
per-partition top-k followed by a k-row merge, with no global sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationflow.functions.measures import agg_exprs, r2, rounded, rounded_mean, rounded_sum
from stationflow.operators.stats import hourly_profile
from stationflow.schema import DAY_OVER_DAY_THRESHOLD, RAIN_THRESHOLD


def hottest_days(daily: DataFrame, k: int = 5) -> DataFrame:
    """Top ``k`` (station, day) by daily maximum temperature."""
    return (
        daily.select("station_name", "date", "max_temp")
        .orderBy(F.desc("max_temp"), "station_name", "date")
        .limit(k)
    )


def monthly_trend(raw: DataFrame) -> DataFrame:
    """Temperature trend per calendar month from the raw readings."""
    return (
        raw.groupBy("month")
        .agg(
            *agg_exprs(
                {
                    "avg_temp": rounded_mean("temperature_c"),
                    "min_temp": rounded("min(temperature_c)"),
                    "max_temp": rounded("max(temperature_c)"),
                    "total_readings": "count(1)",
                }
            )
        )
        .orderBy("month")
    )


def anomaly_leaderboard(daily: DataFrame) -> DataFrame:
    """Stations by labelled anomalies, with the unweighted mean of their daily means."""
    return (
        daily.groupBy("station_id", "station_name")
        .agg(
            *agg_exprs(
                {
                    "total_anomalies": "sum(anomaly_count)",
                    "avg_daily_temp": rounded_mean("avg_temp"),
                }
            )
        )
        .orderBy(F.desc("total_anomalies"))
    )


def rainy_days(daily: DataFrame, threshold: float = RAIN_THRESHOLD, k: int = 20) -> DataFrame:
    """Top ``k`` (station, day) with more than ``threshold`` mm of rain."""
    return (
        daily.where(F.col("total_precipitation") > threshold)
        .select("station_name", "date", "total_precipitation", "avg_temp", "avg_humidity")
        .orderBy(F.desc("total_precipitation"), "station_name", "date")
        .limit(k)
    )


def station_conditions(daily: DataFrame) -> DataFrame:
    """Per station name: means of the daily means, total rain and anomalies."""
    return (
        daily.groupBy("station_name")
        .agg(
            *agg_exprs(
                {
                    "overall_avg_temp": rounded_mean("avg_temp"),
                    "overall_avg_humidity": rounded_mean("avg_humidity"),
                    "overall_avg_wind": rounded_mean("avg_wind_speed"),
                    "total_rain": rounded_sum("total_precipitation"),
                    "total_anomalies": "sum(anomaly_count)",
                }
            )
        )
        .orderBy(F.desc("overall_avg_temp"))
    )


def hourly_pattern(raw: DataFrame) -> DataFrame:
    """Diurnal cycle from the raw table (same result as the batch hourly profile)."""
    return hourly_profile(raw)


def day_over_day_change(daily: DataFrame, threshold: float = DAY_OVER_DAY_THRESHOLD, k: int = 20) -> DataFrame:
    """Largest jumps of a station's daily mean temperature from the previous calendar day.

    A self equi-join on (station_id, date = previous date + 1): a station with a
    missing day yields no row for the day after the gap.  Keys are
    (station, day), so a hot station spreads over all its days.
    """
    a = daily.select("station_id", "station_name", "date", F.col("avg_temp").alias("current_avg"))
    b = daily.select(
        F.col("station_id").alias("_b_station"),
        F.date_add("date", 1).alias("_b_next"),
        F.col("avg_temp").alias("previous_avg"),
    )
    joined = a.join(b, (a.station_id == b._b_station) & (a.date == b._b_next))
    return (
        joined.where(F.abs(F.col("current_avg") - F.col("previous_avg")) > threshold)
        .select(
            "station_name",
            F.col("date").alias("day"),
            "current_avg",
            "previous_avg",
            r2(F.col("current_avg") - F.col("previous_avg")).alias("temp_change"),
        )
        .orderBy(F.desc(F.abs("temp_change")), "station_name", "day")
        .limit(k)
    )
