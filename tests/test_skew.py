"""A station holding a large share of all readings must not land in one task."""

from __future__ import annotations

from conftest import SF_CHECK, reading
from pyspark.sql import functions as F

from stationflow.functions.time import event_time
from stationflow.operators import stats
from stationflow.operators.enrich import enrich_time
from stationflow.operators.windows import flatten_window, pane_stats, sliding_window_stats, sliding_window_stats_batch
from stationflow.plans import registry


def _hot(spark):
    """sf0.01 readings with ~40% of them moved to station ST001."""
    wire = registry.with_event_time(spark, SF_CHECK)
    hot = F.xxhash64("timestamp", "temperature_c", "wind_speed_kmh") % 5 < 2
    return wire.withColumn("station_id", F.when(hot, F.lit("ST001")).otherwise(F.col("station_id"))).withColumn(
        "station_name", F.when(hot, F.lit("HOT")).otherwise(F.col("station_name"))
    )


def test_a_hot_station_hour_costs_its_panes(spark, make_readings):
    rows = [reading(station_id="HOT", timestamp=f"2024-01-01 10:{i % 60:02d}:{i % 59:02d}", temperature_c=i / 7) for i in range(2000)]
    rows += [reading(station_id=f"S{i % 9}", timestamp=f"2024-01-{1 + i % 27:02d} {i % 24:02d}:00:00") for i in range(3000)]
    df = make_readings(rows).withColumn("event_time", event_time("timestamp"))
    panes = pane_stats(df)
    assert panes.where("station_id = 'HOT'").count() == 60
    plan = panes._jdf.queryExecution().executedPlan().toString()
    # what is shuffled is the partial aggregate, not the readings
    below = plan[plan.index("Exchange hashpartitioning(station_id") :]
    assert "HashAggregate" in below.split("\n")[1]
    a = sorted(tuple(r) for r in flatten_window(sliding_window_stats(df)).collect())
    assert a == sorted(tuple(r) for r in flatten_window(sliding_window_stats_batch(df)).collect())


def test_hot_station_results_unchanged(spark):
    df = _hot(spark)
    a = sorted(tuple(r) for r in flatten_window(sliding_window_stats(df)).collect())
    b = sorted(tuple(r) for r in flatten_window(sliding_window_stats_batch(df)).collect())
    assert a == b
    readings = enrich_time(df.drop("event_time"))
    daily = stats.daily_station_stats(readings, ordered=False)
    hot = daily.where("station_id = 'ST001'").agg(F.sum("num_readings")).collect()[0][0]
    assert hot == readings.where("station_id = 'ST001'").count()
