"""Time enrichment: parse the wire timestamp and derive date, hour and month."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from stationflow.functions.time import wall_clock


def enrich_time(df: DataFrame) -> DataFrame:
    """Add ``date``, ``hour``, ``month``; ``timestamp`` becomes wall-clock TIMESTAMP_NTZ.

    Text that does not parse gives a null timestamp (and null date/hour/month)
    instead of failing the job.  ``month`` ignores the year, as the reports do.
    """
    if isinstance(df.schema["timestamp"].dataType, StringType):
        ts = wall_clock("timestamp")
    else:
        ts = F.col("timestamp").cast("timestamp_ntz")
    out = df.withColumn("timestamp", ts)
    return out.withColumns(
        {
            "date": F.expr("to_date(`timestamp`)"),
            "hour": F.expr("CAST(hour(`timestamp`) AS INT)"),
            "month": F.expr("CAST(month(`timestamp`) AS INT)"),
        }
    )
