"""Every registered query against its DuckDB oracle on the smallest test tables."""

from __future__ import annotations

import os
import sys

import pytest
from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))

import __spark_entry__ as entry  # noqa: E402
from parity import digest, duck  # noqa: E402

from stationflow.plans.registry import queries  # noqa: E402

KEYS = sorted(queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["station_id", "station_name", "date"]


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    sdf = queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(entry.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


SESSION_SENSITIVE = ["enriched_readings", "sliding_window_stats", "alerts", "decoded_payloads", "day_over_day_change"]


@pytest.mark.parametrize("key", SESSION_SENSITIVE)
def test_results_do_not_depend_on_session_settings(spark, con, key):
    changed = {
        "spark.sql.session.timeZone": "Asia/Kolkata",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.ansi.enabled": "false",
        "spark.sql.shuffle.partitions": "23",
    }
    before = {k: spark.conf.get(k) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        sdf = queries()[key](spark, SF_SMALL)
        srows = [tuple(r) for r in sdf.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    cur = con.execute(entry.oracle_sql()[key])
    drows = cur.fetchall()
    assert digest(sdf.columns, srows)[0] == digest([d[0] for d in cur.description], drows)[0]


def test_queries_can_run_concurrently_in_one_session(spark, con):
    from concurrent.futures import ThreadPoolExecutor

    keys = ["alerts_stream", "alerts_stream", "warehouse_roundtrip", "warehouse_roundtrip", "sigma_outliers"]

    def run(key):
        sdf = queries()[key](spark, SF_SMALL)
        return key, sdf.columns, [tuple(r) for r in sdf.collect()]

    with ThreadPoolExecutor(len(keys)) as pool:
        results = list(pool.map(run, keys))
    for key, cols, rows in results:
        cur = con.execute(entry.oracle_sql()[key])
        assert digest(cols, rows)[0] == digest([d[0] for d in cur.description], cur.fetchall())[0]
