"""Intermediate tables of one operator, written as Parquet to the shared scratch folder.

A written table cuts the lineage with files every executor can read, so a lost
executor never forces an operator back to its input, and a later pass reads only
the columns it needs.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.plans.storage import remove_path, scratch_path

#: Bytes, as measured by ``bounded_broadcast``, of the largest table that is sent to every executor.
BROADCAST_BYTES = 16 << 20


class Scratch:
    """Writes named tables of one operator run; ``drop`` frees those no longer read."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = scratch_path(spark, label)
        self._count = 0
        self._paths: dict[str, str] = {}

    def path(self, name: str) -> str:
        self._count += 1
        self._paths[name] = f"{self.root}/{name}-{self._count}"
        return self._paths[name]

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return it as read back; an earlier table of that name stays."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove_path(self.spark, self._paths.pop(name))


def bounded_broadcast(df: DataFrame, width: int | Column, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its rows' ``width`` in bytes adds up to ``limit`` at most.

    ``width`` bounds the bytes of one row: a number, or a column where rows hold
    texts or arrays.  Beyond the limit ``df`` comes back without a hint and Spark
    joins by shuffling.  The sum is one distributed aggregate, so ``df`` should be
    a written table.
    """
    column = F.lit(width) if isinstance(width, int) else width
    size = df.agg(F.sum(column.cast("long")).alias("n")).first()["n"] or 0
    return F.broadcast(df) if size <= limit else df


#: Rows that Spark hands to a Python worker at once: texts may be very long.
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows, so that a worker's memory stays small."""
    now = int(spark.conf.get(_BATCH_CONF, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


#: Settings under which rows that hold long lists are read and handed over few at a time.
_LONG_ROWS = {_BATCH_CONF: "1000", "spark.sql.parquet.columnarReaderBatchSize": "512"}


@contextmanager
def long_rows(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside hold few rows at once; the session's settings come back after them.

    For rows with long lists: the JVM lays out a whole batch, and doubles the space
    of its lists when it is full.
    """
    before = {key: spark.conf.get(key, None) for key in _LONG_ROWS}
    for key, value in _LONG_ROWS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
