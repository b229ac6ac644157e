"""Feed-level summaries and payload encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions.measures import agg_exprs, exact_mean_sql
from stationflow.schema import READING_COLUMNS


def encode_payloads(df: DataFrame, columns: list[str] | None = None, *more: Column) -> DataFrame:
    """One JSON text ``value`` per reading, in wire field order (nulls omitted), and ``more`` columns beside it."""
    cols = columns or READING_COLUMNS
    return df.select(F.to_json(F.struct(*cols)).alias("value"), *more)


def feed_summary(df: DataFrame) -> DataFrame:
    """One row: messages, distinct stations, labelled anomalies, mean temperature.

    A missing temperature counts as 0 in the mean; an empty feed has mean 0.
    A null station id counts as one more station.  The distinct count is a
    two-level aggregate (partial distinct per task, then a keyed shuffle), so
    no task ever sees more than its share of station ids.
    """
    agg = df.agg(
        *agg_exprs(
            {
                "message_count": "count(1)",
                "_distinct": "count(DISTINCT station_id)",
                "_null_station": "max(CAST(station_id IS NULL AS INT))",
                "anomaly_count": "count_if(coalesce(is_anomaly, false))",
                "_mean": exact_mean_sql("coalesce(temperature_c, 0D)"),
            }
        )
    )
    return agg.selectExpr(
        "message_count",
        "_distinct + coalesce(_null_station, 0) AS station_count",
        "anomaly_count",
        "coalesce(round(_mean, 2), 0D) AS avg_temp",
    )
