from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("stationflow-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="sf-warehouse-", dir="/tmp"))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    from stationflow.plans.storage import checkpoint_root

    checkpoint_root(session)  # uses spark.checkpoint.dir, or a temp root when unset
    yield session
    session.stop()


def reading(**over):
    """One wire-form reading with plausible defaults."""
    base = {
        "station_id": "ST001",
        "station_name": "Alpha",
        "latitude": 48.7,
        "longitude": 2.26,
        "timestamp": "2024-01-01 00:00:00",
        "temperature_c": 12.0,
        "humidity_pct": 50.0,
        "pressure_hpa": 1013.25,
        "wind_speed_kmh": 10.0,
        "wind_direction": "N",
        "precipitation_mm": 0.0,
        "is_anomaly": False,
    }
    base.update(over)
    return base


@pytest.fixture
def make_readings(spark):
    from stationflow.schema import READING, READING_COLUMNS

    def make(rows):
        return spark.createDataFrame([tuple(r[c] for c in READING_COLUMNS) for r in rows], READING)

    return make
