"""Readers accept files in the formats the original pipeline writes."""

from __future__ import annotations

import datetime as dt
import tempfile

from stationflow.sources.files import read_readings_csv, read_readings_json

HEADER = (
    "station_id,station_name,latitude,longitude,timestamp,temperature_c,humidity_pct,"
    "pressure_hpa,wind_speed_kmh,wind_direction,precipitation_mm,is_anomaly"
)


def test_csv_with_python_booleans_and_integer_zeros(spark):
    folder = tempfile.mkdtemp(prefix="sf-csv-", dir="/tmp")
    with open(f"{folder}/readings.csv", "w") as f:
        f.write(HEADER + "\n")
        f.write("ST001,Alpha,48.85,2.35,2025-07-15 14:30:00,31.2,45.5,1012.4,0,SW,0,False\n")
        f.write("ST002,Beta,45.76,4.84,2025-07-15 14:30:00,46.1,20.0,1009.9,12.5,N,1.25,True\n")
        f.write("ST003,Gamma,43.3,5.37,not-a-time,oops,30,1000,5,E,0,False\n")
    rows = {r["station_id"]: r for r in read_readings_csv(spark, folder).collect()}
    a, b, c = rows["ST001"], rows["ST002"], rows["ST003"]
    assert a["wind_speed_kmh"] == 0.0 and a["is_anomaly"] is False
    assert b["is_anomaly"] is True and b["precipitation_mm"] == 1.25
    assert a["timestamp"] == dt.datetime(2025, 7, 15, 14, 30) and (a["hour"], a["month"]) == (14, 7)
    # a malformed field nulls that field (and the bad time its derived columns), not the job
    assert c["temperature_c"] is None and c["timestamp"] is None and c["humidity_pct"] == 30.0


def test_json_lines_with_spaces_and_extra_keys(spark):
    folder = tempfile.mkdtemp(prefix="sf-json-", dir="/tmp")
    with open(f"{folder}/stream.jsonl", "w") as f:
        f.write(
            '{"station_id": "ST001", "station_name": "Alpha", "latitude": 48.85, "longitude": 2.35, '
            '"timestamp": "2025-07-15 14:30:00", "temperature_c": 31.2, "humidity_pct": 100, '
            '"pressure_hpa": 1012.4, "wind_speed_kmh": 0, "wind_direction": "SW", '
            '"precipitation_mm": 0, "is_anomaly": false, "extra": [1, 2]}\n'
        )
    r = read_readings_json(spark, folder).collect()[0]
    assert (r["humidity_pct"], r["wind_speed_kmh"], r["is_anomaly"]) == (100.0, 0.0, False)
    assert r["date"] == dt.date(2025, 7, 15)


def _csv(name, *files):
    folder = tempfile.mkdtemp(prefix=f"sf-csv-{name}-", dir="/tmp")
    for i, lines in enumerate(files):
        with open(f"{folder}/readings{i}.csv", "w") as f:
            f.write("\n".join(lines) + "\n")
    return folder


def test_csv_columns_are_found_by_name(spark):
    cols = HEADER.split(",")
    row = dict(zip(cols, "ST001,Alpha,48.85,2.35,2025-07-15 14:30:00,31.2,45.5,1012.4,0,SW,0,False".split(","), strict=True))
    order = ["extra", *reversed(cols)]
    folder = _csv("order", [",".join(order), ",".join({"extra": "x", **row}[c] for c in order)])
    r = read_readings_csv(spark, folder).collect()[0]
    assert (r["station_id"], r["station_name"], r["temperature_c"], r["hour"]) == ("ST001", "Alpha", 31.2, 14)
    assert "extra" not in r.asDict()


def test_csv_bad_cells_are_counted(spark):
    from pyspark.sql import Observation

    folder = _csv("bad", [HEADER, "A,a,48,2,2025-07-15 14:30:00,oops,x,1000,5,E,0,False", "B,b,48,2,,1,,1000,5,E,0,maybe"])
    seen = Observation("cells")
    rows = read_readings_csv(spark, folder, bad_cells=seen).collect()
    assert len(rows) == 2
    assert {k: n for k, n in seen.get.items() if n} == {"temperature_c": 1, "humidity_pct": 1, "is_anomaly": 1}


def test_csv_with_a_missing_column_or_another_header_raises(spark):
    import pytest

    with pytest.raises(ValueError, match="is_anomaly"):
        read_readings_csv(spark, _csv("missing", [HEADER.replace(",is_anomaly", "")]))
    cols = HEADER.split(",")
    other = ",".join([cols[1], cols[0], *cols[2:]])
    row = "ST001,Alpha,48.85,2.35,2025-07-15 14:30:00,31.2,45.5,1012.4,0,SW,0,False"
    with pytest.raises(Exception):
        read_readings_csv(spark, _csv("mixed", [HEADER, row], [other, row])).collect()


def test_wall_clock_keeps_hours_a_zone_skips(spark):
    from stationflow.functions.time import wall_clock

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        texts = ["2024-03-31 02:30:00", "2024-10-27 02:30:00", "2024-03-31", "x", None, "2024-13-01 00:00:00"]
        rows = spark.createDataFrame([(t,) for t in texts], "timestamp string").select(wall_clock().alias("t")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.t for r in rows] == [dt.datetime(2024, 3, 31, 2, 30), dt.datetime(2024, 10, 27, 2, 30), None, None, None, None]
