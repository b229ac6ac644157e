"""Plan shape: the physical strategies the design relies on."""

from __future__ import annotations

from conftest import SF_SMALL

from stationflow.operators import outliers, reports
from stationflow.plans import registry


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_station_registry_is_broadcast(spark):
    plan = _plan(registry.wire(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(reports.hottest_days(registry.daily(spark, SF_SMALL)))
    # props/event_type are needed by the derivation, but nation's region key is not
    assert "n_regionkey" not in plan


def test_top_k_is_take_ordered(spark):
    plan = _plan(reports.rainy_days(registry.daily(spark, SF_SMALL)))
    assert "TakeOrderedAndProject" in plan


def test_outliers_never_shuffle_readings_for_the_baseline_join(spark):
    df = registry.enriched(spark, SF_SMALL)
    plan = _plan(outliers.sigma_outliers(df))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_aggregates_are_partial_then_final(spark):
    from stationflow.operators import stats

    plan = _plan(stats.daily_station_stats(registry.enriched(spark, SF_SMALL), ordered=False))
    assert plan.count("HashAggregate") >= 2


def test_filters_reach_the_parquet_scan_of_stored_tables(spark, tmp_path):
    from stationflow.operators import stats

    raw_path, daily_path = str(tmp_path / "raw"), str(tmp_path / "daily")
    registry.enriched(spark, SF_SMALL).write.parquet(raw_path)
    stats.daily_station_stats(spark.read.parquet(raw_path), ordered=False).write.parquet(daily_path)
    gusty = _plan(stats.gusty_days(spark.read.parquet(raw_path)))
    assert "PushedFilters: [IsNotNull(wind_speed_kmh), GreaterThan(wind_speed_kmh,40.0)]" in gusty
    assert "ReadSchema: struct<station_name:string,wind_speed_kmh:double,date:date>" in gusty
    rainy = _plan(reports.rainy_days(spark.read.parquet(daily_path)))
    assert "GreaterThan(total_precipitation,5.0)" in rainy


def test_alert_thresholds_reach_the_scan(spark, tmp_path):
    from stationflow.operators.alerts import alert_records

    path = str(tmp_path / "wire")
    registry.wire(spark, SF_SMALL).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        pushed = _plan(alert_records(spark.read.parquet(path))).split("PushedFilters: ")[1].split("\n")[0]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    for part in ("GreaterThan(temperature_c,40.0)", "LessThan(temperature_c,-10.0)", "GreaterThan(wind_speed_kmh,80.0)", "LessThan(pressure_hpa,980.0)"):
        assert part in pushed


def test_size_check_plans_no_single_task_exchange_of_rows(spark):
    from stationflow.plans.broadcast import measured_bytes

    small = outliers.station_baseline(registry.enriched(spark, SF_SMALL))
    assert 100 < measured_bytes(small) < 2000
    checked = small.agg({"station_id": "count"})._jdf.queryExecution().executedPlan().toString()
    assert "Limit" not in checked


def test_day_over_day_reads_four_daily_columns(spark):
    plan = _plan(registry.queries()["day_over_day_change"](spark, SF_SMALL))
    assert "max_temp" not in plan and "total_precipitation" not in plan


def test_no_registered_query_plans_a_cross_join(spark):
    for key, q in registry.queries().items():
        df = q(spark, SF_SMALL)
        df.write.format("noop").mode("overwrite").save()
        plan = _plan(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key
