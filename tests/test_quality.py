from conftest import reading

from stationflow.operators.feed import feed_summary
from stationflow.operators.quality import anomaly_rate, cadence_gaps, contract_report, diurnal_contrast
from stationflow.operators.enrich import enrich_time
from stationflow.schema import READING


def test_contract_one_violation_per_rule(make_readings):
    rows = [
        reading(),
        reading(temperature_c=70.0),
        reading(humidity_pct=9.9),
        reading(wind_speed_kmh=-0.1),
        reading(wind_direction="NNE"),
        reading(precipitation_mm=-1.0),
        reading(timestamp="2024/01/01 00:00"),
        reading(station_name=None),
    ]
    out = {r["rule"]: (r["checked"], r["violations"]) for r in contract_report(make_readings(rows)).collect()}
    assert out == {
        "required_fields": (8, 1),
        "temperature_range": (8, 1),
        "humidity_range": (8, 1),
        "wind_non_negative": (8, 1),
        "wind_direction_valid": (8, 1),
        "precipitation_non_negative": (8, 1),
        "timestamp_format": (8, 1),
    }


def test_feed_summary_missing_temperature_and_null_station(make_readings):
    rows = [
        reading(station_id="A", temperature_c=10.0, is_anomaly=True),
        reading(station_id="B", temperature_c=None),
        reading(station_id=None, temperature_c=5.0),
    ]
    r = feed_summary(make_readings(rows)).collect()[0]
    assert (r["message_count"], r["station_count"], r["anomaly_count"], r["avg_temp"]) == (3, 3, 1, 5.0)


def test_feed_summary_empty(spark):
    r = feed_summary(spark.createDataFrame([], READING)).collect()[0]
    assert (r["message_count"], r["station_count"], r["anomaly_count"], r["avg_temp"]) == (0, 0, 0, 0.0)


def test_anomaly_rate_band(make_readings):
    rows = [reading(timestamp=f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00", is_anomaly=i < 2) for i in range(100)]
    r = anomaly_rate(make_readings(rows)).collect()[0]
    assert (r["readings"], r["anomalies"], r["anomaly_rate"], r["within_band"]) == (100, 2, 0.02, True)


def test_diurnal_contrast(make_readings):
    rows = [
        reading(timestamp="2025-07-15 14:00:00", temperature_c=30.0),
        reading(timestamp="2025-07-15 03:00:00", temperature_c=18.0),
        reading(timestamp="2025-01-15 14:00:00", temperature_c=6.0),
    ]
    r = diurnal_contrast(enrich_time(make_readings(rows))).collect()[0]
    assert (r["afternoon_avg"], r["night_avg"], r["diurnal_delta"]) == (18.0, 18.0, 0.0)
    assert (r["summer_avg"], r["winter_avg"], r["seasonal_delta"]) == (24.0, 6.0, 18.0)


def test_cadence_gaps(make_readings):
    rows = [reading(timestamp=f"2024-01-01 {i // 4:02d}:{(i % 4) * 15:02d}:00") for i in range(96)]
    rows += [reading(timestamp="2024-01-02 00:00:00")]
    out = cadence_gaps(enrich_time(make_readings(rows))).collect()
    assert [(str(r["date"]), r["readings"], r["deviation"]) for r in out] == [("2024-01-02", 1, -95)]


def test_cadence_counts_days_without_any_reading(make_readings):
    full = [f"{i // 4:02d}:{(i % 4) * 15:02d}:00" for i in range(96)]
    rows = [reading(timestamp=f"2024-01-0{d} {t}") for d in (1, 4) for t in full]
    rows += [reading(station_id="ST002", timestamp=f"2024-01-05 {t}") for t in full] + [reading(station_id="ST003", timestamp="bad")]
    out = sorted((r["station_id"], str(r["date"]), r["readings"], r["deviation"]) for r in cadence_gaps(enrich_time(make_readings(rows))).collect())
    assert out == [("ST001", "2024-01-02", 0, -96), ("ST001", "2024-01-03", 0, -96), ("ST003", "None", 1, -95)]


def test_contract_on_enriched_readings(make_readings):
    rows = [reading(), reading(timestamp="bad"), reading(humidity_pct=101.0)]
    out = {r["rule"]: (r["checked"], r["violations"]) for r in contract_report(enrich_time(make_readings(rows))).collect()}
    # the unparsable text became a null timestamp: a missing field, not a format error
    assert out["timestamp_format"] == (2, 0)
    assert out["required_fields"] == (3, 1)
    assert out["humidity_range"] == (3, 1)


def test_a_reading_of_a_wrong_year_is_many_small_rows(spark, make_readings):
    from datetime import date

    from stationflow.operators.enrich import enrich_time
    from stationflow.operators.quality import cadence_gaps, cadence_intervals

    rows = [reading(timestamp="2024-01-01 00:00:00"), reading(timestamp="2024-01-02 00:00:00"), reading(timestamp="9999-12-31 00:00:00")]
    df = enrich_time(make_readings(rows))
    intervals = sorted((str(r["first"]), str(r["last"]), r["readings"]) for r in cadence_intervals(df).collect())
    assert intervals == [("2024-01-01", "2024-01-01", 1), ("2024-01-02", "2024-01-02", 1), ("2024-01-03", "9999-12-30", 0), ("9999-12-31", "9999-12-31", 1)]
    gaps = cadence_gaps(df, expected=1)
    assert gaps.count() == (date(9999, 12, 30) - date(2024, 1, 2)).days
    found = gaps.agg({"date": "min", "readings": "max"}).first()
    assert str(found["min(date)"]) == "2024-01-03" and found["max(readings)"] == 0
    assert gaps.select("date").distinct().count() == gaps.count()
