"""Column-level building blocks (all built-in Spark expressions, no UDFs)."""

from stationflow.functions.measures import r2
from stationflow.functions.rules import alert_condition, alert_severity, alert_type
from stationflow.functions.time import event_time, wall_clock

__all__ = [
    "alert_condition",
    "alert_severity",
    "alert_type",
    "event_time",
    "r2",
    "wall_clock",
]
