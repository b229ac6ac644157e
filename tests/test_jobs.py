"""The batch job end to end on a CSV derived from the test tables."""

from __future__ import annotations

import tempfile

from conftest import SF_SMALL

from stationflow.jobs.batch import run_batch
from stationflow.jobs.reports import all_reports
from stationflow.plans import registry
from stationflow.sinks.files import save_csv
from stationflow.sources.files import read_readings_csv


def test_batch_job_and_reports(spark):
    base = tempfile.mkdtemp(prefix="sf-job-", dir="/tmp")
    save_csv(registry.wire(spark, SF_SMALL), f"{base}/input")
    summary = {r["metric"]: r["value"] for r in run_batch(spark, read_readings_csv(spark, f"{base}/input"), f"{base}/out", "sf_job_db").collect()}
    readings = registry.enriched(spark, SF_SMALL)
    assert summary["total_records"] == readings.count()
    assert summary["daily_rows"] == readings.select("station_id", "date").distinct().count()
    assert summary["outliers_detected"] == spark.read.parquet(f"{base}/out/anomalies").count()
    for name in ("daily_aggregations", "monthly_aggregations", "station_rankings", "hourly_patterns",
                 "daily_stats_compact", "station_extremes", "gusty_days"):
        assert spark.read.parquet(f"{base}/out/{name}").count() > 0
    reps = all_reports(spark, "sf_job_db")
    assert reps["hottest_days"].count() == 5
    assert reps["hourly_pattern"].count() == 24


def test_partitioned_external_table_prunes_by_date(spark):
    from stationflow.sinks.files import save_parquet
    from stationflow.sources.warehouse import define_external_table, ensure_database, scan

    base = tempfile.mkdtemp(prefix="sf-ext-", dir="/tmp")
    save_parquet(registry.enriched(spark, SF_SMALL), base, partition_by=["date"])
    ensure_database(spark, "sf_ext_db")
    define_external_table(spark, "sf_ext_db.raw", registry.enriched(spark, SF_SMALL).schema, base, partition_by=["date"])
    define_external_table(spark, "sf_ext_db.raw", registry.enriched(spark, SF_SMALL).schema, base, partition_by=["date"])  # idempotent
    one_day = scan(spark, "sf_ext_db.raw").where("date = DATE'2024-01-05'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert one_day.count() == registry.enriched(spark, SF_SMALL).where("date = DATE'2024-01-05'").count() > 0


def test_streaming_job_starts_three_named_queries(spark):
    import json

    from conftest import reading

    from stationflow.jobs.streaming import start_all
    from stationflow.sources.topics import decode_payload, text_stream

    src = tempfile.mkdtemp(prefix="sf-feed-", dir="/tmp")
    with open(f"{src}/a.jsonl", "w") as f:
        f.write("\n".join(json.dumps(reading(temperature_c=t)) for t in (41.0, 12.0)) + "\n")
    out = tempfile.mkdtemp(prefix="sf-stream-job-", dir="/tmp")
    now = {"availableNow": True}
    qs = start_all(spark, decode_payload(text_stream(spark, src)), out, True, True, now, now, now, closed_windows=True)
    for q in qs:
        q.awaitTermination()
        assert q.exception() is None
    assert sorted(q.name for q in qs) == ["closed_windows", "raw_archive", "weather_alerts", "windowed_stats"]
    assert spark.read.parquet(f"{out}/windows_closed").count() == 0  # nothing is 10 minutes old yet
    assert spark.read.parquet(f"{out}/alerts").count() == 1
    assert spark.read.parquet(f"{out}/raw_parquet").count() == 2
    assert spark.read.parquet(f"{out}/windows").count() == 5


def test_batch_job_defines_both_external_tables(spark):
    from stationflow.operators.stats import daily_station_stats

    base = tempfile.mkdtemp(prefix="sf-ddl-", dir="/tmp")
    readings = registry.enriched(spark, SF_SMALL)
    run_batch(spark, readings, f"{base}/out", "sf_ddl_db")

    def types(schema):
        return sorted((f.name, f.dataType.simpleString()) for f in schema.fields)

    assert types(spark.table("sf_ddl_db.raw_readings").schema) == types(readings.schema)
    assert types(spark.table("sf_ddl_db.daily_stats").schema) == types(daily_station_stats(readings).schema)
    # the tables answer plain SQL with the DDL's names (previous calendar day join)
    n = spark.sql(
        """SELECT count(*) FROM sf_ddl_db.daily_stats a JOIN sf_ddl_db.daily_stats b
           ON a.station_id = b.station_id AND a.`date` = date_add(b.`date`, 1)"""
    ).collect()[0][0]
    assert n > 0


def test_batch_job_clustered_by_date_gives_same_summary(spark):
    base = tempfile.mkdtemp(prefix="sf-cluster-", dir="/tmp")
    readings = registry.enriched(spark, SF_SMALL)
    plain = {r["metric"]: r["value"] for r in run_batch(spark, readings, f"{base}/a", "sf_a_db").collect()}
    clustered = {
        r["metric"]: r["value"] for r in run_batch(spark, readings, f"{base}/b", "sf_b_db", cluster_by_date=True).collect()
    }
    assert plain == clustered


def test_publish_csv_as_payloads_round_trips(spark):
    from stationflow.jobs.publish import payloads
    from stationflow.sources.topics import decode_payload

    base = tempfile.mkdtemp(prefix="sf-pub-", dir="/tmp")
    wire = registry.wire(spark, SF_SMALL)
    save_csv(wire, f"{base}/csv")
    back = decode_payload(payloads(spark, csv=f"{base}/csv")).drop("event_time")
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in wire.collect())


def test_batch_then_reports_as_separate_processes(spark):
    import os
    import subprocess
    import sys

    from conftest import ROOT

    base = tempfile.mkdtemp(prefix="sf-cli-", dir="/tmp")
    save_csv(registry.wire(spark, SF_SMALL), f"{base}/input")
    env = dict(os.environ, PYTHONPATH=ROOT)
    common = ["--master", "local[2]"]
    subprocess.run(
        [sys.executable, "-m", "stationflow.jobs.batch", f"{base}/input", f"{base}/out", *common],
        check=True, cwd=base, env=env, capture_output=True, timeout=600,
    )
    subprocess.run(
        [sys.executable, "-m", "stationflow.jobs.reports", f"{base}/reports", "--base", f"{base}/out", *common],
        check=True, cwd=base, env=env, capture_output=True, timeout=600,
    )
    assert spark.read.parquet(f"{base}/reports/hottest_days").count() == 5
    assert spark.read.parquet(f"{base}/reports/hourly_pattern").count() == 24


def test_streaming_job_cli_available_now_and_restart(spark):
    import os
    import subprocess
    import sys

    from conftest import ROOT

    from stationflow.jobs.publish import payloads

    base = tempfile.mkdtemp(prefix="sf-stream-cli-", dir="/tmp")
    save_csv(registry.wire(spark, SF_SMALL), f"{base}/csv")
    payloads(spark, csv=f"{base}/csv").write.text(f"{base}/feed")
    env = dict(os.environ, PYTHONPATH=ROOT)
    cmd = [sys.executable, "-m", "stationflow.jobs.streaming", f"{base}/out", "--files", f"{base}/feed",
           "--closed-windows", "--available-now", "--master", "local[2]"]
    for _ in range(2):  # the second run resumes from the checkpoints and finds nothing new
        subprocess.run(cmd, check=True, cwd=base, env=env, capture_output=True, timeout=600)
    readings = registry.wire(spark, SF_SMALL)
    assert spark.read.parquet(f"{base}/out/raw_parquet").count() == readings.count()
    from stationflow.operators.alerts import alert_records

    assert spark.read.parquet(f"{base}/out/alerts").count() == alert_records(readings).count()


def test_cluster_shuffle_partitions_scale_with_cores():
    from stationflow.session import cluster_shuffle_partitions

    assert cluster_shuffle_partitions(8) == 200
    assert cluster_shuffle_partitions(8000) == 24000


def test_publish_then_feed_cli(spark):
    import os
    import subprocess
    import sys

    from conftest import ROOT

    base = tempfile.mkdtemp(prefix="sf-pubfeed-", dir="/tmp")
    wire = registry.wire(spark, SF_SMALL)
    save_csv(wire, f"{base}/csv")
    env = dict(os.environ, PYTHONPATH=ROOT)
    common = ["--master", "local[2]"]
    subprocess.run(
        [sys.executable, "-m", "stationflow.jobs.publish", "--csv", f"{base}/csv", "--to-files", f"{base}/feed", *common],
        check=True, cwd=base, env=env, capture_output=True, timeout=600,
    )
    out = subprocess.run(
        [sys.executable, "-m", "stationflow.jobs.feed", "--files", f"{base}/feed", *common],
        check=True, cwd=base, env=env, capture_output=True, text=True, timeout=600,
    ).stdout
    row = [line for line in out.splitlines() if line.startswith("|") and "message_count" not in line][0]
    count, stations = [int(x) for x in row.strip("|").split("|")[:2]]
    assert (count, stations) == (wire.count(), wire.select("station_id").distinct().count())


def test_a_failing_write_is_not_run_twice_and_old_tables_are_replaced(spark, monkeypatch):
    import pytest
    from pyspark.sql import functions as F

    from stationflow.jobs import batch

    base = tempfile.mkdtemp(prefix="sf-fail-", dir="/tmp")
    calls = []
    write = batch.save_parquet
    monkeypatch.setattr(batch, "save_parquet", lambda *a, **k: (calls.append(a[1]), write(*a, **k))[1])
    bad = registry.enriched(spark, SF_SMALL).withColumn("hour", F.raise_error(F.lit("broken cell")).cast("int"))
    with pytest.raises(Exception, match="broken cell"):
        run_batch(spark, bad, f"{base}/out", "sf_fail_db")
    assert len(calls) == 1
    readings = registry.enriched(spark, SF_SMALL)
    run_batch(spark, readings, f"{base}/first", "sf_fail_db")
    run_batch(spark, readings.where("station_id = 'ST001'"), f"{base}/second", "sf_fail_db")
    assert spark.table("sf_fail_db.raw_readings").select("station_id").distinct().count() == 1


def test_batch_job_writes_few_files_per_date(spark):
    import os

    base = tempfile.mkdtemp(prefix="sf-files-", dir="/tmp")
    readings = registry.enriched(spark, SF_SMALL).repartition(8)
    run_batch(spark, readings, f"{base}/out", "sf_files_db")
    dates = readings.select("date").distinct().count()
    files = [f for _, _, names in os.walk(f"{base}/out/warehouse/raw_readings") for f in names if f.endswith(".parquet")]
    assert len(files) <= dates + 8


def test_scratch_keys_leave_no_table(spark):
    for key in ("warehouse_roundtrip", "hourly_pattern_table", "warehouse_roundtrip"):
        registry.queries()[key](spark, SF_SMALL).count()
    assert spark.catalog.listTables(registry.SCRATCH_DATABASE) == []
    assert not spark.catalog.databaseExists("weather_db")


def test_new_days_replace_only_themselves(spark, make_readings, tmp_path):
    """A second run over corrected and new days gives what one run over everything gives."""
    from conftest import reading

    from stationflow.jobs.batch import OUTPUTS, run_batch
    from stationflow.operators.enrich import enrich_time

    def days(*ds, shift=0.0):
        return [
            reading(timestamp=f"2024-01-0{d} {h:02d}:30:00", temperature_c=d + h / 10 + shift, wind_speed_kmh=35.0 + h)
            for d in ds
            for h in range(0, 24, 3)
        ]

    first, second = days(1, 2, 3), days(3, 4, shift=20.0)
    whole = days(1, 2) + second
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    run_batch(spark, enrich_time(make_readings(first)), a, "new_days_a")
    kept = {p: p.stat().st_mtime_ns for p in (tmp_path / "a" / "warehouse").glob("*/date=2024-01-0[12]/*.parquet")}
    assert kept
    summary = run_batch(spark, enrich_time(make_readings(second)), a, "new_days_a", new_days=True).collect()
    want = run_batch(spark, enrich_time(make_readings(whole)), b, "new_days_b").collect()
    assert sorted(map(str, summary)) == sorted(map(str, want))
    assert all(p.exists() and p.stat().st_mtime_ns == t for p, t in kept.items())
    for name in OUTPUTS:
        own, other = (sorted(str(tuple(r)) for r in spark.read.parquet(f"{d}/{name}").collect()) for d in (a, b))
        assert own == other, name
