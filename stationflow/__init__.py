"""stationflow: Spark-native analytics for station telemetry.

Operators are pure ``DataFrame -> DataFrame`` functions that work on batch and
streaming DataFrames alike; sources and sinks wrap Spark's readers and writers.
"""

__version__ = "0.1.0"
