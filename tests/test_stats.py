import datetime as dt

import pytest
from conftest import reading

from stationflow.operators import reports, stats
from stationflow.operators.enrich import enrich_time
from stationflow.operators.outliers import sigma_outliers, station_baseline


def test_enrich_time_parses_and_derives(make_readings):
    out = enrich_time(make_readings([reading(timestamp="2025-07-15 14:30:00"), reading(timestamp="not a time")]))
    rows = out.orderBy("timestamp").collect()
    bad, good = rows
    assert bad["timestamp"] is None and bad["date"] is None and bad["hour"] is None
    assert good["timestamp"] == dt.datetime(2025, 7, 15, 14, 30)
    assert (good["date"], good["hour"], good["month"]) == (dt.date(2025, 7, 15), 14, 7)


def test_daily_stats_values(make_readings):
    rows = [
        reading(timestamp="2024-01-01 00:00:00", temperature_c=10.0, precipitation_mm=0.1, is_anomaly=True),
        reading(timestamp="2024-01-01 00:15:00", temperature_c=11.0, precipitation_mm=0.2, is_anomaly=None),
        reading(timestamp="2024-01-01 00:30:00", temperature_c=12.35, precipitation_mm=0.0),
        reading(timestamp="2024-01-02 00:00:00", temperature_c=5.0),
    ]
    out = stats.daily_station_stats(enrich_time(make_readings(rows))).collect()
    assert [r["date"] for r in out] == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    d1 = out[0]
    assert d1["avg_temp"] == 11.12  # (10 + 11 + 12.35) / 3 = 11.1166..
    assert (d1["min_temp"], d1["max_temp"]) == (10.0, 12.35)
    assert d1["total_precipitation"] == 0.3
    assert (d1["num_readings"], d1["anomaly_count"]) == (3, 1)


def test_rounding_is_half_up_on_exact_mean(make_readings):
    # 0.125 is exact in binary; the exact mean of 0.12 and 0.13 is 0.125 -> 0.13.
    rows = [reading(temperature_c=0.12), reading(temperature_c=0.13)]
    out = stats.daily_station_stats(enrich_time(make_readings(rows))).collect()[0]
    assert out["avg_temp"] == 0.13


def test_exact_mean_does_not_depend_on_partitioning(spark, make_readings):
    rows = [reading(timestamp=f"2024-01-01 00:{i % 60:02d}:00", temperature_c=0.1 * (i % 97) + 0.01) for i in range(500)]
    df = enrich_time(make_readings(rows))
    a = stats.hourly_profile(df.repartition(1)).collect()
    b = stats.hourly_profile(df.repartition(7)).collect()
    assert a == b


def test_month_ignores_year(make_readings):
    rows = [
        reading(timestamp="2024-01-10 00:00:00", temperature_c=1.0),
        reading(timestamp="2025-01-10 00:00:00", temperature_c=3.0),
        reading(timestamp="2025-02-10 00:00:00", temperature_c=5.0),
    ]
    df = enrich_time(make_readings(rows))
    monthly = [(r["month"], r["avg_temp"], r["num_readings"]) for r in stats.monthly_stats(df).collect()]
    assert monthly == [(1, 2.0, 2), (2, 5.0, 1)]
    trend = [(r["month"], r["total_readings"]) for r in reports.monthly_trend(df).collect()]
    assert trend == [(1, 2), (2, 1)]


def test_gusty_days_strict_threshold(make_readings):
    rows = [
        reading(wind_speed_kmh=40.0),
        reading(wind_speed_kmh=40.05, timestamp="2024-01-01 01:00:00"),
        reading(wind_speed_kmh=55.55, timestamp="2024-01-01 02:00:00"),
    ]
    out = stats.gusty_days(enrich_time(make_readings(rows))).collect()
    assert [(r["max_gust"], r["high_wind_readings"]) for r in out] == [(55.6, 2)]


def test_single_reading_station_is_never_an_outlier(spark, make_readings):
    rows = [reading(station_id="LONE", temperature_c=99.0)]
    rows += [reading(station_id="MANY", timestamp=f"2024-01-01 00:{i:02d}:00", temperature_c=10.0) for i in range(30)]
    rows += [reading(station_id="MANY", timestamp="2024-01-01 01:00:00", temperature_c=60.0)]
    df = enrich_time(make_readings(rows))
    base = {r["station_id"]: r for r in station_baseline(df).collect()}
    assert base["LONE"]["std_temp"] is None
    out = sigma_outliers(df).collect()
    assert [(r["station_id"], r["temperature_c"]) for r in out] == [("MANY", 60.0)]


def test_outlier_plan_broadcasts_checked_baseline(spark, make_readings):
    df = enrich_time(make_readings([reading(), reading(timestamp="2024-01-01 00:15:00")]))
    plan = sigma_outliers(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_outliers_beyond_the_broadcast_bound_use_a_shuffle_join(spark):
    from conftest import SF_SMALL

    from stationflow.plans import registry

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry.enriched(spark, SF_SMALL)
        small = sigma_outliers(df)
        big = sigma_outliers(df, max_broadcast_bytes=100)  # 10 stations take more: no hint
        big_plan = big._jdf.queryExecution().executedPlan().toString()
        # the baseline side is not broadcast: a shuffle join (the registry join stays broadcast)
        assert "SortMergeJoin" in big_plan or "ShuffledHashJoin" in big_plan
        assert sorted(tuple(r) for r in big.collect()) == sorted(tuple(r) for r in small.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def _one(make_readings, values, **agg):
    from stationflow.functions.measures import agg_exprs, exact_mean_sql, exact_sum_sql

    df = make_readings([reading(temperature_c=v) for v in values])
    row = df.agg(*agg_exprs({"total": exact_sum_sql("temperature_c"), "mean": exact_mean_sql("temperature_c")})).first()
    plain = df.agg({"temperature_c": "sum"}).first()[0], df.agg({"temperature_c": "avg"}).first()[0]
    return (row["total"], row["mean"]), plain


def test_means_and_sums_cover_all_of_every_value(make_readings):
    from math import isnan

    for values in ([2e15, 1.0], [0.00004] * 1000, [0.00004, 0.00004], [1e300, -3.5], [float("inf"), 1.0], [1.23456789, None, -7.1]):
        got, plain = _one(make_readings, values)
        assert got == pytest.approx(plain, rel=1e-12), values
    got, _ = _one(make_readings, [10.0, float("nan"), 20.0])
    assert isnan(got[0]) and isnan(got[1])
    assert _one(make_readings, [None, None])[0] == (None, None)
    assert _one(make_readings, [0.1, 0.2, 0.3])[0] == (0.6, 0.6 / 3)


def test_compact_daily_and_station_projections_equal_their_own_aggregates(spark):
    from conftest import SF_SMALL

    from stationflow.operators import stats
    from stationflow.plans import registry

    readings = registry.enriched(spark, SF_SMALL)
    stations = stats.station_statistics(readings)
    assert sorted(stats.ranking_of(stations).collect()) == sorted(stats.station_ranking(readings).collect())
    own = readings.groupBy("station_id").agg({"temperature_c": "max"}).collect()
    assert {r[0]: round(r[1], 2) for r in own} == {r.station_id: r.record_high for r in stats.extremes_of(stations).collect()}


def test_presentation_orders(make_readings):
    from stationflow.operators import reports, stats

    rows = []
    for month in (1, 2, 7):
        for day in (1, 2, 3, 28):
            for s in range(9):
                t = 10 * ((s * 7 + day * 3 + month) % 11) - 30
                rows.append(reading(station_id=f"S{s}", station_name=f"N{8 - s}", timestamp=f"2024-{month:02d}-{day:02d} 0{s}:00:00",
                                    temperature_c=float(t), wind_speed_kmh=41.0 + (s * day) % 13, precipitation_mm=6.0 + s, is_anomaly=s % 2 == 0))
    e = enrich_time(make_readings(rows))
    daily = stats.daily_station_stats(e)

    def ordered(df, key):
        got = df.collect()
        assert len(got) > 1 and got == sorted(got, key=key)
        return got

    ordered(daily, lambda r: (r.station_id, r.date))
    ordered(stats.daily_station_stats_compact(e), lambda r: (r.station_id, r.date))
    assert [r.month for r in ordered(stats.monthly_stats(e), lambda r: r.month)] == [1, 2, 7]
    assert [r.month for r in ordered(reports.monthly_trend(e), lambda r: r.month)] == [1, 2, 7]
    ordered(stats.hourly_profile(e), lambda r: r.hour)
    ordered(stats.station_ranking(e), lambda r: (-r.avg_temp, r.station_id))
    ordered(stats.station_extremes(e), lambda r: (-r.record_high, r.station_id))
    ordered(stats.gusty_days(e), lambda r: -r.max_gust)
    ordered(reports.hottest_days(daily), lambda r: (-r.max_temp, r.station_name, r.date))
    ordered(reports.rainy_days(daily), lambda r: (-r.total_precipitation, r.station_name, r.date))
    ordered(reports.anomaly_leaderboard(daily), lambda r: -r.total_anomalies)
    ordered(reports.station_conditions(daily), lambda r: -r.overall_avg_temp)
    assert len(ordered(reports.day_over_day_change(daily), lambda r: (-abs(r.temp_change), r.station_name, r.day))) == 20


def test_day_over_day_change_crosses_a_month_boundary(make_readings):
    from stationflow.operators import reports, stats

    rows = [reading(timestamp=f"{d} 00:00:00", temperature_c=t) for d, t in (("2024-01-31", 0.0), ("2024-02-01", 9.0), ("2024-02-03", 30.0))]
    got = reports.day_over_day_change(stats.daily_station_stats(enrich_time(make_readings(rows)))).collect()
    assert [(str(r.day), r.temp_change) for r in got] == [("2024-02-01", 9.0)]
