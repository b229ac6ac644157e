"""Data-quality reports: the reading contract checked as one pass over a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stationflow.functions.measures import agg_exprs, exact_mean_sql
from stationflow.functions.time import event_time
from stationflow.schema import (
    ANOMALY_RATE_BAND,
    COMPASS,
    HUMIDITY_RANGE,
    READING_COLUMNS,
    READINGS_PER_DAY,
    TEMP_PLAUSIBLE,
)


def _rules(text_timestamp: bool = True) -> list[tuple[str, F.Column, F.Column]]:
    """(rule name, value checked when non-null, violation predicate)."""
    temp, hum = F.col("temperature_c"), F.col("humidity_pct")
    wind, rain = F.col("wind_speed_kmh"), F.col("precipitation_mm")
    direction, ts = F.col("wind_direction"), F.col("timestamp")
    any_null = F.lit(False)
    for c in READING_COLUMNS:
        any_null = any_null | F.col(c).isNull()
    return [
        ("required_fields", F.lit(1), any_null),
        ("temperature_range", temp, (temp <= TEMP_PLAUSIBLE[0]) | (temp >= TEMP_PLAUSIBLE[1])),
        ("humidity_range", hum, (hum < HUMIDITY_RANGE[0]) | (hum > HUMIDITY_RANGE[1])),
        ("wind_non_negative", wind, wind < 0),
        ("wind_direction_valid", direction, ~direction.isin(*COMPASS)),
        ("precipitation_non_negative", rain, rain < 0),
        # text must parse; an already parsed timestamp passes by construction
        ("timestamp_format", ts, event_time(ts).isNull() if text_timestamp else F.lit(False)),
    ]


def contract_report(df: DataFrame) -> DataFrame:
    """(rule, checked, violations) for each contract rule over wire-form or enriched readings.

    One aggregate pass computes every counter (map-side partial counts), and a
    ``stack`` turns the single result row into one row per rule.
    """
    rules = _rules(isinstance(df.schema["timestamp"].dataType, StringType))
    aggs = []
    for i, (_, value, bad) in enumerate(rules):
        aggs.append(F.count(value).alias(f"c{i}"))
        aggs.append(F.count_if(value.isNotNull() & F.coalesce(bad, F.lit(False))).alias(f"v{i}"))
    row = df.agg(*aggs)
    stacked = []
    for i, (name, _, _) in enumerate(rules):
        stacked += [F.lit(name), F.col(f"c{i}"), F.col(f"v{i}")]
    return row.select(F.stack(F.lit(len(rules)), *stacked).alias("rule", "checked", "violations"))


def anomaly_rate(df: DataFrame, band: tuple[float, float] = ANOMALY_RATE_BAND) -> DataFrame:
    """Share of labelled anomalies per station, and whether it lies inside ``band``."""
    per = df.groupBy("station_id", "station_name").agg(
        F.count(F.lit(1)).alias("readings"),
        F.count_if(F.coalesce(F.col("is_anomaly"), F.lit(False))).alias("anomalies"),
    )
    rate = F.col("anomalies") / F.col("readings")
    return per.withColumn("anomaly_rate", rate).withColumn(
        "within_band", (F.col("anomaly_rate") > band[0]) & (F.col("anomaly_rate") < band[1])
    )


def diurnal_contrast(
    df: DataFrame,
    afternoon_hour: int = 14,
    night_hour: int = 3,
    summer_month: int = 7,
    winter_month: int = 1,
) -> DataFrame:
    """Per station: mean temperature in two time-of-day and two seasonal slices,
    and the differences (afternoon - night, summer - winter)."""
    def sliced(pred: str) -> str:
        return exact_mean_sql(f"CASE WHEN {pred} THEN temperature_c END")

    per = df.groupBy("station_id", "station_name").agg(
        *agg_exprs(
            {
                "_a": sliced(f"hour = {afternoon_hour}"),
                "_n": sliced(f"hour = {night_hour}"),
                "_s": sliced(f"month = {summer_month}"),
                "_w": sliced(f"month = {winter_month}"),
            }
        )
    )
    return per.selectExpr(
        "station_id",
        "station_name",
        "round(_a, 2) AS afternoon_avg",
        "round(_n, 2) AS night_avg",
        "round(_a - _n, 2) AS diurnal_delta",
        "round(_s, 2) AS summer_avg",
        "round(_w, 2) AS winter_avg",
        "round(_s - _w, 2) AS seasonal_delta",
    )


#: Days of a gap that are listed from one row.
GAP_DAYS = 1024


def cadence_intervals(df: DataFrame) -> DataFrame:
    """(station_id, first, last, readings): every day with readings, and every gap between two such days.

    A day is an interval of its own; a gap is one row, however long, with 0 readings.
    """
    days = df.groupBy("station_id", "date").agg(F.count(F.lit(1)).alias("readings"))
    following = F.lead("date").over(Window.partitionBy("station_id").orderBy("date"))
    own = "struct(date AS first, date AS last, readings)"
    gap = "struct(date_add(date, 1) AS first, date_sub(following, 1) AS last, 0L AS readings)"
    both = f"CASE WHEN date_add(date, 1) < following THEN array({own}, {gap}) ELSE array({own}) END"
    return days.withColumn("following", following).select("station_id", F.expr(f"inline({both})"))


def cadence_gaps(df: DataFrame, expected: int = READINGS_PER_DAY) -> DataFrame:
    """Station-days whose reading count differs from the expected cadence.

    A day without any reading between a station's first and last day counts 0.
    Gaps stay intervals until they are listed: each is cut into stretches of
    ``GAP_DAYS`` days, which are dealt to the tasks, so a reading of a wrong year
    costs many small rows instead of one with millions of days.
    """
    odd = cadence_intervals(df).where(F.col("readings") != expected)
    stretches = odd.select(
        "station_id", "first", "last", "readings",
        F.explode(F.expr(f"sequence(0, coalesce(datediff(last, first), 0) DIV {GAP_DAYS})")).alias("stretch"),
    ).repartition("station_id", "first", "stretch")
    low = f"date_add(first, CAST(stretch * {GAP_DAYS} AS INT))"
    day = f"CASE WHEN first IS NULL THEN array(first) ELSE sequence({low}, least(last, date_add({low}, {GAP_DAYS - 1}))) END"
    return stretches.select(
        "station_id",
        F.explode(F.expr(day)).alias("date"),
        "readings",
        F.lit(expected).cast("long").alias("expected_readings"),
        (F.col("readings") - expected).alias("deviation"),
    )
