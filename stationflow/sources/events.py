"""Station readings derived from the ``events`` and ``nation`` tables.

The test data has no weather feed, so readings are derived, deterministically,
from ``events`` (one reading per event) with ``nation`` keys 0..9 as the
station dimension.  The mapping is a fixture contract: the DuckDB oracle in
``stationflow.plans.oracle`` builds the same rows with the same formulas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.schema import COMPASS, READING_COLUMNS, TIMESTAMP_FORMAT

# --- Fixed values of the fixture mapping (see FIXTURES.md §2). ---
STATIONS = 10
LAT_BASE, LAT_STEP = 48.7, 0.025
LON_BASE, LON_STEP = 2.26, 0.015
PRESSURE_DROP_EVERY = 50
PRESSURE_DROP_HPA = 30.0
# --- end of fixed values ---


# Column types of the source tables (as written in the test data).
SOURCE_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; known tables are read with their fixed schema (no footer inference)."""
    reader = spark.read
    if name in SOURCE_SCHEMAS:
        reader = reader.schema(SOURCE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _compass_sql(expr: str) -> str:
    codes = ", ".join(f"'{c}'" for c in COMPASS)
    return f"element_at(array({codes}), CAST({expr} AS INT) + 1)"


def readings_from_events(events: DataFrame, nation: DataFrame) -> DataFrame:
    """Wire-form readings (12 columns, ``timestamp`` as text), one per event."""
    # One row per station key 0..STATIONS-1 by construction: a proven bound,
    # so the registry is broadcast without counting it first.
    stations = F.broadcast(
        nation.where(F.col("n_nationkey").between(0, STATIONS - 1))
        .groupBy(F.col("n_nationkey").cast("long").alias("_s"))
        .agg(F.max("n_name").alias("station_name"))
    )
    base = events.selectExpr(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        "try_cast(regexp_extract(props, '[0-9]+', 0) AS INT) AS _k",
        f"user_id % {STATIONS} AS _s",
    )
    return base.join(stations, "_s").selectExpr(
        "concat('ST', lpad(CAST(_s + 1 AS STRING), 3, '0')) AS station_id",
        "station_name",
        f"{LAT_BASE}D + {LAT_STEP}D * _s AS latitude",
        f"{LON_BASE}D + {LON_STEP}D * _s AS longitude",
        # formatting the wall clock drops the fraction: the same text as
        # truncating to the second, with no time-zone conversion involved
        f"date_format(ts, '{TIMESTAMP_FORMAT}') AS timestamp",
        "floor((12D + value / 12D - _k / 4.4D) * 10D + 0.5D) / 10D AS temperature_c",
        "10D + _k * 9 / 10D AS humidity_pct",
        f"1013.25D + (_k - 50) / 5D - CASE WHEN event_id % {PRESSURE_DROP_EVERY} = 0 "
        f"THEN {PRESSURE_DROP_HPA}D ELSE 0D END AS pressure_hpa",
        "floor(value / 3D * 10D + 0.5D) / 10D AS wind_speed_kmh",
        f"{_compass_sql('user_id % 8')} AS wind_direction",
        "CASE WHEN _k % 10 < 3 THEN floor(value) / 100D ELSE 0D END AS precipitation_mm",
        "event_type = 'error' AND _k < 10 AS is_anomaly",
    )


def load_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wire-form readings for a test-data folder."""
    return readings_from_events(load_table(spark, sf_dir, "events"), load_table(spark, sf_dir, "nation")).select(
        *READING_COLUMNS
    )
