"""Randomised checks against plain-Python restatements (one DataFrame per example)."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from conftest import reading
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from stationflow.operators.alerts import alert_records
from stationflow.operators.enrich import enrich_time
from stationflow.operators.quality import contract_report
from stationflow.operators.stats import daily_station_stats

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

# values with at most two decimals, as readings carry
two_dec = st.integers(min_value=-6000, max_value=6000).map(lambda i: i / 100)
maybe = lambda s: st.one_of(st.none(), s)

readings = st.lists(
    st.fixed_dictionaries(
        {
            "station_id": st.sampled_from(["ST001", "ST002", "ST003"]),
            "hour": st.integers(0, 23),
            "day": st.integers(1, 3),
            "temperature_c": maybe(two_dec),
            "wind_speed_kmh": maybe(st.integers(0, 15000).map(lambda i: i / 100)),
            "pressure_hpa": maybe(st.integers(95000, 104000).map(lambda i: i / 100)),
            "humidity_pct": maybe(st.integers(0, 11000).map(lambda i: i / 100)),
            "precipitation_mm": maybe(st.integers(-10, 900).map(lambda i: i / 100)),
            "is_anomaly": maybe(st.booleans()),
        }
    ),
    min_size=1,
    max_size=120,
)


def _rows(draw):
    return [
        reading(
            station_id=d["station_id"],
            station_name=d["station_id"].lower(),
            timestamp=f"2024-01-0{d['day']} {d['hour']:02d}:00:00",
            **{k: d[k] for k in ("temperature_c", "wind_speed_kmh", "pressure_hpa", "humidity_pct", "precipitation_mm", "is_anomaly")},
        )
        for d in draw
    ]


def _round2(x: Fraction) -> float:
    # Spark rounds HALF_UP the shortest decimal text of the double mean.
    return float(Decimal(repr(float(x))).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


@SETTINGS
@given(readings)
def test_daily_stats_match_exact_arithmetic(make_readings, draw):
    rows = _rows(draw)
    got = {(r["station_id"], r["date"].day): r for r in daily_station_stats(enrich_time(make_readings(rows))).collect()}
    groups: dict = {}
    for r in rows:
        groups.setdefault((r["station_id"], int(r["timestamp"][8:10])), []).append(r)
    assert set(got) == set(groups)
    for key, members in groups.items():
        temps = [Fraction(str(m["temperature_c"])) for m in members if m["temperature_c"] is not None]
        rain = [Fraction(str(m["precipitation_mm"])) for m in members if m["precipitation_mm"] is not None]
        g = got[key]
        assert g["num_readings"] == len(members)
        assert g["anomaly_count"] == sum(1 for m in members if m["is_anomaly"])
        assert g["avg_temp"] == (_round2(sum(temps) / len(temps)) if temps else None)
        assert g["total_precipitation"] == (_round2(sum(rain)) if rain else None)


@SETTINGS
@given(readings)
def test_alerts_match_rule_list(make_readings, draw):
    rows = _rows(draw)

    def classify(r):
        t, w, p = r["temperature_c"], r["wind_speed_kmh"], r["pressure_hpa"]
        if t is not None and t > 40:
            return "EXTREME_HEAT"
        if t is not None and t < -10:
            return "EXTREME_COLD"
        if w is not None and w > 80:
            return "DANGEROUS_WIND"
        if p is not None and p < 980:
            return "LOW_PRESSURE_STORM"
        return None

    want = sorted(c for c in map(classify, rows) if c)
    got = sorted(r["alert_type"] for r in alert_records(make_readings(rows)).collect())
    assert got == want


@SETTINGS
@given(readings)
def test_contract_counts(make_readings, draw):
    rows = _rows(draw)
    out = {r["rule"]: (r["checked"], r["violations"]) for r in contract_report(make_readings(rows)).collect()}
    hum = [r["humidity_pct"] for r in rows if r["humidity_pct"] is not None]
    rain = [r["precipitation_mm"] for r in rows if r["precipitation_mm"] is not None]
    assert out["humidity_range"] == (len(hum), sum(1 for h in hum if h < 10 or h > 100))
    assert out["precipitation_non_negative"] == (len(rain), sum(1 for p in rain if p < 0))
    nullish = sum(1 for r in rows if any(v is None for v in r.values()))
    assert out["required_fields"] == (len(rows), nullish)


times = st.one_of(
    st.none(),
    st.builds(
        lambda d, h, m, s: f"{d} {h:02d}:{m:02d}:{s:02d}",
        st.sampled_from(["1969-12-31", "2024-01-01", "2024-01-02", "2024-02-29"]),
        st.sampled_from([0, 1, 23]),
        st.one_of(st.integers(0, 59), st.sampled_from([0, 1, 2, 3, 4, 56, 59])),
        st.integers(0, 59),
    ),
)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["ST001", "ST002"]), times, two_dec), min_size=1, max_size=150))
def test_pane_windows_equal_window_function(make_readings, draw):
    from stationflow.functions.time import event_time
    from stationflow.operators.windows import flatten_window, sliding_window_stats, sliding_window_stats_batch

    rows = [reading(station_id=s, timestamp=ts, temperature_c=t) for s, ts, t in draw]
    df = make_readings(rows).withColumn("event_time", event_time("timestamp"))
    a = sorted(tuple(r) for r in flatten_window(sliding_window_stats(df)).collect())
    b = sorted(tuple(r) for r in flatten_window(sliding_window_stats_batch(df)).collect())
    assert a == b


@SETTINGS
@given(
    st.lists(
        st.tuples(st.sampled_from(["ST001", "ST002", None]), maybe(two_dec), maybe(st.booleans())),
        min_size=0,
        max_size=80,
    )
)
def test_feed_summary_matches_a_single_consumer(make_readings, draw):
    from stationflow.operators.feed import feed_summary

    rows = [reading(station_id=s, temperature_c=t, is_anomaly=a) for s, t, a in draw]
    got = feed_summary(make_readings(rows)).collect()[0]
    count = len(rows)
    stations = {r["station_id"] for r in rows}  # a null id is one more station, as in a set
    anomalies = sum(1 for r in rows if r["is_anomaly"])
    total = sum(Fraction(str(r["temperature_c"])) if r["temperature_c"] is not None else 0 for r in rows)
    mean = _round2(total / count) if count else 0.0
    assert (got["message_count"], got["station_count"], got["anomaly_count"], got["avg_temp"]) == (
        count,
        len(stations),
        anomalies,
        mean,
    )
