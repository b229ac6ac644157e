"""Timestamp parsing that never fails a job.

Spark 4 runs with ANSI mode on, where ``to_timestamp`` raises on bad text and
kills a streaming query; ``try_to_timestamp`` returns null instead, which is
what a 3.x job without ANSI did.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationflow.schema import TIMESTAMP_FORMAT

#: Texts of the wire format; the cast alone would take other forms too.
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def event_time(col: str | Column = "timestamp") -> Column:
    """Parse wire text into an instant (``TIMESTAMP``), as watermarks need."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c, F.lit(TIMESTAMP_FORMAT))


def wall_clock(col: str | Column = "timestamp") -> Column:
    """Parse wire text into a wall-clock ``TIMESTAMP_NTZ``.

    The text names no zone, so none enters: hours that the session's zone skips
    or repeats come back as they were written.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.rlike(TIMESTAMP_PATTERN), c.try_cast("timestamp_ntz"))

