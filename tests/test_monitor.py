"""Processing-time triggers, the event log, and the end of a job when one query fails."""

from __future__ import annotations

import json
import os
import tempfile
import time

from conftest import reading

from stationflow.jobs.streaming import start_all
from stationflow.sources.topics import decode_payload, text_stream
from stationflow.streaming import queries as sq
from stationflow.streaming.monitor import EventLog, read_events, slow_batches, wait_for_any


def _dir():
    return tempfile.mkdtemp(prefix="sf-monitor-", dir="/tmp")


def _put(src, i):
    with open(os.path.join(src, f".part-{i}"), "w") as f:
        f.write(json.dumps(reading(temperature_c=41.0 + i)) + "\n")
    os.rename(os.path.join(src, f".part-{i}"), os.path.join(src, f"part-{i}.jsonl"))


def _until(test, seconds=60):
    end = time.time() + seconds
    while not test():
        assert time.time() < end, "not in time"
        time.sleep(0.2)


def test_triggers_fire_and_a_failed_query_ends_the_job(spark):
    src, out = _dir(), _dir()
    log = EventLog(spark, f"{out}/events")
    spark.streams.addListener(log)
    every = {"processingTime": "1 second"}
    _put(src, 0)
    parsed = decode_payload(text_stream(spark, src, 1))
    queries = start_all(spark, parsed, out, alert_trigger=every, window_trigger=every, archive_trigger=every)
    try:
        done = lambda q, n: sum(p["numInputRows"] > 0 for p in q.recentProgress) >= n
        _until(lambda: all(done(q, 1) for q in queries))
        _put(src, 1)
        _until(lambda: all(done(q, 2) for q in queries))
        assert wait_for_any(spark, queries, timeout=0.5) is None and all(q.isActive for q in queries)

        def fail(batch, batch_id):
            raise ValueError("planted failure")

        bad = parsed.writeStream.foreachBatch(fail).queryName("bad").option("checkpointLocation", _dir()).trigger(**every).start()
        ended = wait_for_any(spark, [*queries, bad], timeout=60)
        assert ended.name == "bad" and "planted failure" in str(ended.exception())
        assert not any(q.isActive for q in queries)
        _until(lambda: {"failed", "ended"} <= {r["event"] for r in read_events(spark, f"{out}/events").collect()})
    finally:
        for q in queries:
            q.stop()
        spark.streams.removeListener(log)
    events = read_events(spark, f"{out}/events")
    rows = {(r["query"], r["event"]): r["n"] for r in events.groupBy("query", "event").count().withColumnRenamed("count", "n").collect()}
    names = {sq.ALERTS_QUERY, sq.WINDOWS_QUERY, sq.ARCHIVE_QUERY}
    assert all(rows[n, "started"] == 1 and rows[n, "progress"] >= 2 and rows[n, "ended"] == 1 for n in names)
    failed = events.where("event = 'failed'").first()
    assert failed["query"] == "bad" and "planted failure" in failed["error"]
    batches = {r["query"]: r["batches"] for r in slow_batches(events, 1).collect()}
    assert all(batches[n] >= 2 for n in names)


def test_a_query_that_ended_before_does_not_end_the_wait(spark):
    src = _dir()
    _put(src, 0)
    lines = text_stream(spark, src, 1)
    start = lambda: lines.writeStream.format("noop").option("checkpointLocation", _dir()).start()
    start().stop()  # no one has waited for this one
    query = start()
    try:
        began = time.monotonic()
        assert wait_for_any(spark, [query], timeout=3) is None
        assert time.monotonic() - began >= 3 and query.isActive
    finally:
        query.stop()
    assert wait_for_any(spark, [query], timeout=3) is query
