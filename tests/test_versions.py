"""Versioned outputs: readers during a rewrite, cut runs, partitions, the batch job."""

from __future__ import annotations

import pytest

from stationflow.sinks import versions
from stationflow.sinks.files import save_parquet
from stationflow.sinks.versions import read_current, save_version
from stationflow.sources.warehouse import define_version_table, drop_table, ensure_database

SCHEMA = "date date, n int"


def rows(df):
    return sorted((str(r.date), r.n) for r in df.collect())


@pytest.fixture
def make(spark):
    return lambda *pairs: spark.createDataFrame(list(pairs), "d string, n int").selectExpr("CAST(d AS date) AS date", "n")


A, B, C = "2024-01-01", "2024-01-02", "2024-01-03"


@pytest.mark.parametrize("by", [None, "date"])
def test_a_reader_keeps_its_rows_while_the_output_is_rewritten(spark, make, tmp_path, by):
    path = str(tmp_path / "out")
    save_version(make((A, 1), (B, 2)), path, by)
    before = read_current(spark, path)
    save_version(before.selectExpr("date", "n + 10 AS n"), path, by)  # also from its own rows
    assert rows(before) == [(A, 1), (B, 2)]
    assert rows(read_current(spark, path)) == [(A, 11), (B, 12)]
    assert read_current(spark, path).schema == make((A, 1)).select("n", "date").schema if by else True
    save_version(make((C, 3)), path, by)
    save_version(make((C, 4)), path, by)
    assert rows(read_current(spark, path)) == [(C, 4)]
    assert sorted(p.name for p in (tmp_path / "out" / "_versions").iterdir()) == ["version=3", "version=4"]


@pytest.mark.parametrize("by", [None, "date"])
@pytest.mark.parametrize("step", ["write", "pointer", "clean"])
def test_a_failed_run_leaves_the_old_rows(spark, make, tmp_path, monkeypatch, by, step):
    path = str(tmp_path / "out")
    save_version(make((A, 1)), path, by)

    def cut(*args, **kw):
        if step == "write":
            save_parquet(*args, **kw)
        raise RuntimeError("cut")

    with monkeypatch.context() as m:
        if step == "pointer":
            m.setattr(versions.pointer, "replace_pointer", cut)
        if step == "clean":
            m.setattr(versions, "_clean", cut)
        with pytest.raises(RuntimeError, match="cut"):
            save_version(make((B, 2)), path, by, write=cut if step == "write" else save_parquet)
    assert rows(read_current(spark, path)) == ([(B, 2)] if step == "clean" else [(A, 1)])
    save_version(make((C, 3)), path, by)
    assert rows(read_current(spark, path)) == [(C, 3)]


def test_partitions_are_replaced_alone_and_null_and_empty_ones_work(spark, make, tmp_path):
    path = str(tmp_path / "out")
    save_version(make((A, 1), (B, 2), (None, 9)), path, "date")
    first = {p: p.stat().st_mtime_ns for p in tmp_path.glob(f"out/_versions/*/date={A}/*.parquet")}
    assert first
    for n in (3, 4, 5):
        save_version(make((B, n), (C, n)), path, "date", keep_others=True)
        assert rows(read_current(spark, path)) == [(A, 1), (B, n), (C, n), ("None", 9)]
    assert all(p.stat().st_mtime_ns == t for p, t in first.items())
    assert len(list(tmp_path.glob(f"out/_versions/*/date={B}"))) == 2  # in force, and the one before
    plan = read_current(spark, path).where(f"date = DATE'{A}'")
    assert "PartitionFilters: [isnotnull(date" in plan._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="partitioned by"):
        save_version(make((A, 1)), path, keep_others=True)
    save_version(make((A, 1)).limit(0), path, "date")
    assert read_current(spark, path).count() == 0
    plain = str(tmp_path / "plain")
    save_parquet(make((A, 1)), plain)
    assert rows(read_current(spark, plain)) == [(A, 1)]


@pytest.mark.parametrize("by", [None, "date"])
def test_tables_are_switched_to_the_new_version(spark, make, tmp_path, by):
    path, name = str(tmp_path / "out"), f"sf_versions_db.t_{by or 'whole'}"
    ensure_database(spark, "sf_versions_db")
    drop_table(spark, name)
    for pairs in ([(A, 1), (B, 2), (None, 7)], [(B, 3), (C, 4)], [(None, 8), (C, 5)], [(A, 6)]):
        save_version(make(*pairs), path, by)
        define_version_table(spark, name, path)
        assert rows(spark.table(name)) == sorted((str(d), n) for d, n in pairs)
    save_version(make((A, 1)).selectExpr("date", "n", "'x' AS extra"), path, by)  # other columns
    define_version_table(spark, name, path)
    assert "extra" in spark.table(name).columns and spark.table(name).count() == 1


def test_versioned_batch_job_equals_the_plain_one(spark, make_readings, tmp_path):
    from conftest import reading

    from stationflow.jobs.batch import OUTPUTS, run_batch
    from stationflow.jobs.reports import all_reports
    from stationflow.operators.enrich import enrich_time

    def days(*ds, shift=0.0):
        made = [
            reading(timestamp=f"2024-01-0{d} {h:02d}:30:00", temperature_c=d + h / 10 + shift, wind_speed_kmh=35.0 + h)
            for d in ds
            for h in range(0, 24, 3)
        ]
        return enrich_time(make_readings(made))

    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    run_batch(spark, days(1, 2, 3), a, "sf_versioned_a", versioned=True)
    reader = read_current(spark, f"{a}/warehouse/raw_readings")
    summary = run_batch(spark, days(3, 4, shift=20.0), a, "sf_versioned_a", new_days=True, versioned=True).collect()
    assert reader.count() == 24  # planned before the second run
    want = run_batch(spark, days(1, 2).unionByName(days(3, 4, shift=20.0)), b, "sf_versioned_b").collect()
    assert sorted(map(str, summary)) == sorted(map(str, want))
    for name in OUTPUTS:
        own, other = read_current(spark, f"{a}/{name}"), spark.read.parquet(f"{b}/{name}")
        assert sorted(map(str, own.collect())) == sorted(map(str, other.collect())), name
    by_table, by_path, plain = (all_reports(spark, d, base) for d, base in (("sf_versioned_a", None), ("", a), ("", b)))
    for name, df in plain.items():
        same = sorted(map(str, df.collect()))
        assert same == sorted(map(str, by_table[name].collect())) == sorted(map(str, by_path[name].collect())), name
