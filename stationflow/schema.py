"""One schema for every entry point: CSV files, JSON payloads and warehouse tables.

A *reading* is one sensor sample keyed by (station_id, timestamp).  On the wire
(CSV text, JSON payloads) ``timestamp`` is text; :func:`stationflow.operators.enrich.enrich_time`
turns it into a wall-clock ``TIMESTAMP_NTZ`` and adds ``date``, ``hour`` and ``month``.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    StringType,
    StructField,
    StructType,
)

# --- Fixed values that must equal the reference's for identical results. ---
# Wire schema of a reading, in wire order.
READING = StructType(
    [
        StructField("station_id", StringType()),
        StructField("station_name", StringType()),
        StructField("latitude", DoubleType()),
        StructField("longitude", DoubleType()),
        StructField("timestamp", StringType()),
        StructField("temperature_c", DoubleType()),
        StructField("humidity_pct", DoubleType()),
        StructField("pressure_hpa", DoubleType()),
        StructField("wind_speed_kmh", DoubleType()),
        StructField("wind_direction", StringType()),
        StructField("precipitation_mm", DoubleType()),
        StructField("is_anomaly", BooleanType()),
    ]
)

READING_COLUMNS = [f.name for f in READING.fields]
ENRICHED_COLUMNS = READING_COLUMNS + ["date", "hour", "month"]

# Columns kept by the raw stream archive.
ARCHIVE_COLUMNS = [
    "station_id",
    "station_name",
    "event_time",
    "temperature_c",
    "humidity_pct",
    "pressure_hpa",
    "wind_speed_kmh",
    "precipitation_mm",
]

# Columns an alert carries downstream.
ALERT_COLUMNS = [
    "station_id",
    "station_name",
    "timestamp",
    "temperature_c",
    "wind_speed_kmh",
    "pressure_hpa",
    "alert_type",
    "alert_severity",
]

# Columns of an outlier.
OUTLIER_COLUMNS = [
    "station_id",
    "station_name",
    "timestamp",
    "temperature_c",
    "wind_speed_kmh",
    "pressure_hpa",
    "is_anomaly",
]

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TEMP_HIGH = 40.0
TEMP_LOW = -10.0
WIND_HIGH = 80.0
PRESSURE_LOW = 980.0
OUTLIER_SIGMAS = 3.0
GUST_THRESHOLD = 40.0
RAIN_THRESHOLD = 5.0
DAY_OVER_DAY_THRESHOLD = 5.0
WINDOW_SIZE = "5 minutes"
WINDOW_SLIDE = "1 minute"
WATERMARK_DELAY = "10 minutes"
COMPASS = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]
ALERT_TYPES = ["EXTREME_HEAT", "EXTREME_COLD", "DANGEROUS_WIND", "LOW_PRESSURE_STORM"]
CRITICAL_ALERTS = ["EXTREME_HEAT", "DANGEROUS_WIND"]
# Reading contract (plausible ranges) checked by the data-quality report.
TEMP_PLAUSIBLE = (-50.0, 70.0)  # exclusive bounds
HUMIDITY_RANGE = (10.0, 100.0)  # inclusive bounds
ANOMALY_RATE_BAND = (0.005, 0.05)  # exclusive bounds
READINGS_PER_DAY = 96  # one reading every 15 minutes
# Names a user of the original pipeline addresses: database, topic, query names.
DATABASE = "weather_db"
TOPIC = "weather-raw"
ALERTS_QUERY, WINDOWS_QUERY, ARCHIVE_QUERY = "weather_alerts", "windowed_stats", "raw_archive"
# --- end of fixed values ---

# Values of up to this many decimals are summed exactly, as integer units of 10**-MEASURE_SCALE.
MEASURE_SCALE = 4
