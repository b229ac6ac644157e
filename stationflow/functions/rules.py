"""Alert rules as column expressions, shared by batch and streaming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationflow.schema import CRITICAL_ALERTS, PRESSURE_LOW, TEMP_HIGH, TEMP_LOW, WIND_HIGH


def _rules() -> list[tuple[Column, str]]:
    temp = F.col("temperature_c")
    wind = F.col("wind_speed_kmh")
    pressure = F.col("pressure_hpa")
    # Precedence: first matching rule names the alert.
    return [
        (temp > TEMP_HIGH, "EXTREME_HEAT"),
        (temp < TEMP_LOW, "EXTREME_COLD"),
        (wind > WIND_HIGH, "DANGEROUS_WIND"),
        (pressure < PRESSURE_LOW, "LOW_PRESSURE_STORM"),
    ]


def alert_condition() -> Column:
    """True when any strict threshold is crossed.

    A null measure crosses nothing: the condition is then true through another
    measure, false or null, and ``where`` drops the last two alike.  The bare OR
    reaches the scan as pushed filters.
    """
    cond = None
    for pred, _ in _rules():
        cond = pred if cond is None else (cond | pred)
    return cond


def alert_type() -> Column:
    expr = None
    for pred, name in _rules():
        expr = F.when(pred, name) if expr is None else expr.when(pred, name)
    return expr.otherwise("UNKNOWN")


def alert_severity(type_col: str = "alert_type") -> Column:
    return F.when(F.col(type_col).isin(*CRITICAL_ALERTS), "CRITICAL").otherwise("WARNING")
