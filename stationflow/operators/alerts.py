"""Extreme-weather alerts: a stateless filter + classification, batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stationflow.functions.rules import alert_condition, alert_severity, alert_type
from stationflow.schema import ALERT_COLUMNS


def detect_alerts(df: DataFrame) -> DataFrame:
    """Rows crossing a threshold, with ``alert_type`` and ``alert_severity`` added.

    Precedence HEAT > COLD > WIND > PRESSURE; CRITICAL for heat and wind.
    """
    return (
        df.where(alert_condition())
        .withColumn("alert_type", alert_type())
        .withColumn("alert_severity", alert_severity())
    )


def alert_records(df: DataFrame) -> DataFrame:
    """``detect_alerts`` projected to the emitted alert columns."""
    return detect_alerts(df).select(*ALERT_COLUMNS)
