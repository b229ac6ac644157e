"""Progress and failures of the running queries, kept where a restart can read them.

A listener writes one JSON file per event under ``<folder>/<query name>/``: the
progress of every batch, and how the query ended.  ``wait_for_any`` ends a job with
the first of its queries that ends, stops the others and says which one it was.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

EVENT = "query string, run string, event string, batch_id long, rows long, duration_ms long, state_rows long, error string"


class EventLog(StreamingQueryListener):
    """Stores progress and terminations of this session's queries under ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.names: dict[str, str] = {}

    def onQueryStarted(self, event) -> None:
        self.names[str(event.runId)] = event.name or str(event.id)
        self._put(str(event.runId), "started", -1)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = sum(s.numRowsTotal for s in p.stateOperators)
        took = (p.durationMs or {}).get("triggerExecution", 0)
        self.names.setdefault(str(p.runId), p.name or str(p.id))
        self._put(str(p.runId), "progress", p.batchId, rows=p.numInputRows, duration_ms=took, state_rows=state)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._put(str(event.runId), "failed" if event.exception else "ended", -1, error=event.exception)

    def _put(self, run: str, kind: str, batch_id: int, **values) -> None:
        query = self.names.get(run, run)
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{query}/{kind}-{run}-{batch_id}.json")
        fs = path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        stream = fs.create(path, True)
        stream.write(bytearray(json.dumps({"query": query, "run": run, "event": kind, "batch_id": batch_id} | values).encode()))
        stream.close()


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    """The stored events of all queries, a row each."""
    return spark.read.schema(EVENT).json(f"{folder.rstrip('/')}/*/*.json")


def slow_batches(events: DataFrame, trigger_ms: int) -> DataFrame:
    """Batches that took longer than their trigger: (query, batches, slow, longest_ms)."""
    own = events.where("event = 'progress' AND rows > 0")
    slow = F.count_if(F.col("duration_ms") > trigger_ms)
    return own.groupBy("query").agg(F.count("*").alias("batches"), slow.alias("slow"), F.max("duration_ms").alias("longest_ms"))


def wait_for_any(spark: SparkSession, queries: list[StreamingQuery], timeout: float | None = None) -> StreamingQuery | None:
    """Wait until one of ``queries`` has ended, stop the others, and return it (None after ``timeout`` seconds)."""
    end = None if timeout is None else time.monotonic() + timeout
    while not (ended := [q for q in queries if not q.isActive]):
        left = None if end is None else end - time.monotonic()
        if left is not None and left <= 0:
            return None
        try:
            spark.streams.awaitAnyTermination(left)
        except Exception:  # noqa: BLE001 - the failed query is found and reported below
            pass
        if all(q.isActive for q in queries):  # another query has ended: it would end every later wait at once
            spark.streams.resetTerminated()
    first = next((q for q in ended if q.exception() is not None), ended[0])
    for q in queries:
        if q.isActive:
            q.stop()
    spark.streams.resetTerminated()
    return first
