"""Exact second moments: the same deviation for any order and partitioning."""

from __future__ import annotations

import math
import random
import statistics
from fractions import Fraction

import pytest
from conftest import reading

from stationflow.functions.measures import agg_exprs, exact_stddev_sql
from stationflow.operators.enrich import enrich_time
from stationflow.operators.outliers import sigma_outliers, station_baseline


def _std(spark, values, parts=1):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return df.agg(*agg_exprs({"s": exact_stddev_sql("x")})).first()["s"]


def _true(values):
    """The deviation from the exact rational variance of the decimal values."""
    exact = [Fraction(round(v * 10_000), 10_000) for v in values]
    return math.sqrt(statistics.variance(exact))


@pytest.mark.parametrize("scale", [1.0, 1e6, 1e10])
def test_equals_the_rational_variance(spark, scale):
    rng = random.Random(4)
    values = [round(rng.uniform(-1, 1) * scale, 4) for _ in range(300)]
    assert _std(spark, values) == pytest.approx(_true(values), rel=1e-14)


def test_bit_equal_for_any_order_and_partitioning(spark):
    rng = random.Random(8)
    values = [round(rng.gauss(20, 7), 1) for _ in range(2000)] + [20.0] * 3000
    found = set()
    for parts in (1, 2, 7):
        rng.shuffle(values)
        found.add(_std(spark, values, parts))
    assert len(found) == 1
    # no cancellation: a constant offset leaves the deviation of small values as it is
    assert _std(spark, [1e9 + x for x in (0.0, 0.5, 1.0)]) == 0.5


def test_null_single_and_other_values(spark):
    assert _std(spark, [None, None]) is None and _std(spark, [3.0]) is None and _std(spark, [3.0, None]) is None
    assert _std(spark, [3.0, 3.0, None]) == 0.0
    assert math.isnan(_std(spark, [1.0, float("nan"), 2.0]))
    # values beyond four decimals or 2**50 units take Spark's own deviation
    for values in ([0.123456, 0.5, 7.0], [1e300, 2.0, 3.0], [1e12, 3e12]):
        want = spark.createDataFrame([(v,) for v in values], "x double").selectExpr("stddev_samp(x)").first()[0]
        assert repr(_std(spark, values)) == repr(want)
    # many large values: the integer numerator takes more than 38 digits
    big = [float(v) for v in (10**11 - 1, -(10**11) + 7, 10**11 - 3)] * 400
    assert _std(spark, big, 3) == pytest.approx(_true(big), rel=1e-12)


def test_a_reading_at_three_sigma_never_flips(spark, make_readings):
    rows = [reading(station_id="A", timestamp=f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00", temperature_c=20.0 + (-1) ** i * 0.1 * (i % 9)) for i in range(300)]
    rows.append(reading(station_id="A", timestamp="2024-01-02 00:00:00", temperature_c=22.3))
    seen = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = enrich_time(make_readings(rows)).repartition(1 + 3 * seed)
        base = tuple(station_baseline(df).drop("station_id").first())
        seen.add((base, tuple(sorted(str(r) for r in sigma_outliers(df).collect()))))
    assert len(seen) == 1
