"""Broadcast joins behind a measured size bound.

A broadcast hint is only attached after one distributed aggregate has measured
the side's bytes: every task sums its own rows, and one row per task meets in
the end.  Beyond the bound the DataFrame is returned unhinted and Catalyst plans
a shuffle join, with the same rows either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Per-station side tables take some 60 bytes a row: about a million stations.
MAX_BROADCAST_BYTES = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows: the text of string columns, 16 for any other, 16 a row."""
    width = F.lit(16)
    for field in df.schema.fields:
        text = isinstance(field.dataType, StringType)
        width = width + (F.coalesce(F.octet_length(field.name), F.lit(0)) + 8 if text else F.lit(16))
    return df.agg(F.sum(width.cast("long")).alias("bytes")).first()["bytes"] or 0


def broadcast_if_bounded(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``F.broadcast(df)`` when ``df`` measures at most ``max_bytes``, else ``df`` unchanged.

    ``df`` should be cheap to read: a small dimension scan or a materialized
    (checkpointed) aggregate.
    """
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df
