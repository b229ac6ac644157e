"""Run summary: row counts of a batch run's outputs, one (metric, value) row each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_summary(daily: DataFrame, outliers: DataFrame) -> DataFrame:
    """Total readings, daily-stat rows and outliers, as three (metric, value) rows.

    Every reading lands in exactly one daily group, so the reading total is the
    sum of ``num_readings``: one pass over the daily table yields both counts,
    and the raw readings are not scanned again.
    """
    totals = daily.agg(
        F.coalesce(F.sum("num_readings"), F.lit(0)).cast("long").alias("total_records"),
        F.count(F.lit(1)).alias("daily_rows"),
    )
    counts = totals.select(
        F.stack(
            F.lit(2),
            F.lit("total_records"),
            F.col("total_records"),
            F.lit("daily_rows"),
            F.col("daily_rows"),
        ).alias("metric", "value")
    )
    found = outliers.agg(F.count(F.lit(1)).alias("value")).select(F.lit("outliers_detected").alias("metric"), "value")
    return counts.unionByName(found)
