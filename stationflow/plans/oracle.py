"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each string runs on DuckDB with the test tables registered as views.  The
``readings`` CTE rebuilds the station readings from ``events`` and ``nation``
with the fixture formulas; the rest restates each report in plain SQL.

Two helpers make results comparable bit for bit:

* ``_r(x, n)`` rounds HALF_UP on the shortest decimal text of the double, as
  Spark's ``round`` does (DuckDB would otherwise scale in binary).
* ``_xmean`` / ``_xsum`` sum as DECIMAL(38,12): independent of row order and of
  the units and residuals that the Spark side adds up.
"""

from __future__ import annotations


def _r(expr: str, n: int = 2) -> str:
    return f"CAST(round(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,17)), {n}) AS DOUBLE)"


def _dec(col: str) -> str:
    return f"TRY_CAST(({col}) AS DECIMAL(38,12))"


def _xsum(col: str) -> str:
    return f"CAST(SUM({_dec(col)}) AS DOUBLE)"


def _xmean(col: str) -> str:
    return f"(CAST(SUM({_dec(col)}) AS DOUBLE) / COUNT({_dec(col)}))"


def _n(expr: str) -> str:
    """Integer count/sum as BIGINT (DuckDB sums integers to HUGEINT)."""
    return f"CAST(({expr}) AS BIGINT)"


READINGS_CTE = """
ev AS (
    SELECT event_id, ts, user_id, event_type, value,
           TRY_CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS k,
           user_id % 10 AS s
    FROM events
),
readings AS (
    SELECT 'ST' || lpad(CAST(s + 1 AS VARCHAR), 3, '0') AS station_id,
           n.n_name AS station_name,
           48.7e0 + 0.025e0 * s AS latitude,
           2.26e0 + 0.015e0 * s AS longitude,
           CAST(date_trunc('second', ts) AS TIMESTAMP) AS "timestamp",
           floor((12e0 + value / 12e0 - k / 4.4e0) * 10e0 + 0.5e0) / 10e0 AS temperature_c,
           10e0 + k * 9 / 10e0 AS humidity_pct,
           1013.25e0 + (k - 50) / 5e0 - CASE WHEN event_id % 50 = 0 THEN 30e0 ELSE 0e0 END AS pressure_hpa,
           floor(value / 3e0 * 10e0 + 0.5e0) / 10e0 AS wind_speed_kmh,
           CASE user_id % 8 WHEN 0 THEN 'N' WHEN 1 THEN 'NE' WHEN 2 THEN 'E' WHEN 3 THEN 'SE'
                WHEN 4 THEN 'S' WHEN 5 THEN 'SW' WHEN 6 THEN 'W' ELSE 'NW' END AS wind_direction,
           CASE WHEN k % 10 < 3 THEN floor(value) / 100e0 ELSE 0e0 END AS precipitation_mm,
           (event_type = 'error' AND k < 10) AS is_anomaly,
           CAST(ts AS DATE) AS "date",
           CAST(hour(ts) AS INTEGER) AS hour,
           CAST(month(ts) AS INTEGER) AS month
    FROM ev JOIN nation n ON n.n_nationkey = ev.s
)"""

DAILY_CTE = f"""
daily AS (
    SELECT station_id, station_name, "date",
           {_r(_xmean('temperature_c'))} AS avg_temp,
           {_r('MIN(temperature_c)')} AS min_temp,
           {_r('MAX(temperature_c)')} AS max_temp,
           {_r(_xmean('humidity_pct'))} AS avg_humidity,
           {_r(_xmean('pressure_hpa'))} AS avg_pressure,
           {_r(_xmean('wind_speed_kmh'))} AS avg_wind_speed,
           {_r(_xsum('precipitation_mm'))} AS total_precipitation,
           {_n('COUNT(*)')} AS num_readings,
           {_n('COUNT(*) FILTER (WHERE coalesce(is_anomaly, false))')} AS anomaly_count
    FROM readings
    GROUP BY station_id, station_name, "date"
)"""

WIRE_TS = """strftime("timestamp", '%Y-%m-%d %H:%M:%S')"""

ENRICHED_COLUMNS_SQL = (
    'station_id, station_name, latitude, longitude, "timestamp", temperature_c, humidity_pct, '
    "pressure_hpa, wind_speed_kmh, wind_direction, precipitation_mm, is_anomaly, \"date\", hour, month"
)

WIRE_COLUMNS_SQL = (
    f"station_id, station_name, latitude, longitude, {WIRE_TS} AS \"timestamp\", temperature_c, "
    "humidity_pct, pressure_hpa, wind_speed_kmh, wind_direction, precipitation_mm, is_anomaly"
)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _readings(body: str) -> str:
    return _with(READINGS_CTE) + body


def _daily(body: str) -> str:
    return _with(READINGS_CTE, DAILY_CTE) + body


BASELINE_SELECT = f"""
    SELECT station_id,
           {_xmean('temperature_c')} AS mean_temp, stddev_samp(temperature_c) AS std_temp,
           {_xmean('wind_speed_kmh')} AS mean_wind, stddev_samp(wind_speed_kmh) AS std_wind
    FROM readings GROUP BY station_id"""

OUTLIERS_SELECT = f"""
    SELECT r.station_id, r.station_name, r."timestamp", r.temperature_c, r.wind_speed_kmh,
           r.pressure_hpa, r.is_anomaly
    FROM readings r JOIN ({BASELINE_SELECT}) b ON r.station_id = b.station_id
    WHERE abs(r.temperature_c - b.mean_temp) > 3e0 * b.std_temp
       OR abs(r.wind_speed_kmh - b.mean_wind) > 3e0 * b.std_wind"""

ALERTS_SELECT = f"""
    SELECT station_id, station_name, {WIRE_TS} AS "timestamp", temperature_c, wind_speed_kmh, pressure_hpa,
           CASE WHEN temperature_c > 40e0 THEN 'EXTREME_HEAT'
                WHEN temperature_c < -10e0 THEN 'EXTREME_COLD'
                WHEN wind_speed_kmh > 80e0 THEN 'DANGEROUS_WIND'
                WHEN pressure_hpa < 980e0 THEN 'LOW_PRESSURE_STORM'
                ELSE 'UNKNOWN' END AS alert_type,
           CASE WHEN temperature_c > 40e0 THEN 'CRITICAL'
                WHEN temperature_c < -10e0 THEN 'WARNING'
                WHEN wind_speed_kmh > 80e0 THEN 'CRITICAL'
                ELSE 'WARNING' END AS alert_severity
    FROM readings
    WHERE temperature_c > 40e0 OR temperature_c < -10e0 OR wind_speed_kmh > 80e0 OR pressure_hpa < 980e0"""

WINDOWS_SELECT = f"""
    SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, station_id, station_name,
           {_r(_xmean('temperature_c'))} AS avg_temp,
           {_r('MAX(temperature_c)')} AS max_temp,
           {_r('MIN(temperature_c)')} AS min_temp,
           {_r(_xmean('humidity_pct'))} AS avg_humidity,
           {_r(_xmean('wind_speed_kmh'))} AS avg_wind,
           {_n('COUNT(*)')} AS reading_count
    FROM (SELECT r.*, date_trunc('minute', r."timestamp") - to_minutes(CAST(t.i AS BIGINT)) AS window_start
          FROM readings r CROSS JOIN range(5) AS t(i)
          WHERE r."timestamp" IS NOT NULL) w
    GROUP BY window_start, station_id, station_name"""

HOURLY_SELECT = f"""
    SELECT hour,
           {_r(_xmean('temperature_c'))} AS avg_temp,
           {_r(_xmean('humidity_pct'))} AS avg_humidity,
           {_r(_xmean('wind_speed_kmh'))} AS avg_wind
    FROM readings GROUP BY hour"""


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["enriched_readings"] = _readings(f"SELECT {ENRICHED_COLUMNS_SQL} FROM readings")
    q["daily_station_stats"] = _daily("SELECT * FROM daily")
    q["refreshed_daily_stats"] = q["daily_station_stats"]
    q["daily_station_stats_compact"] = _readings(
        f"""SELECT station_id, station_name, "date",
           {_r(_xmean('temperature_c'))} AS avg_temp,
           {_r('MIN(temperature_c)')} AS min_temp,
           {_r('MAX(temperature_c)')} AS max_temp,
           {_r(_xmean('humidity_pct'))} AS avg_humidity,
           {_r(_xmean('wind_speed_kmh'))} AS avg_wind,
           {_r(_xsum('precipitation_mm'))} AS total_precip,
           {_n('COUNT(*)')} AS readings
        FROM readings GROUP BY station_id, station_name, "date" """
    )
    q["monthly_stats"] = _readings(
        f"""SELECT month,
           {_r(_xmean('temperature_c'))} AS avg_temp,
           {_r('MIN(temperature_c)')} AS min_temp,
           {_r('MAX(temperature_c)')} AS max_temp,
           {_r(_xmean('humidity_pct'))} AS avg_humidity,
           {_r(_xsum('precipitation_mm'))} AS total_precipitation,
           {_n('COUNT(*)')} AS num_readings
        FROM readings GROUP BY month"""
    )
    q["station_ranking"] = _readings(
        f"""SELECT station_id, station_name,
           {_r(_xmean('temperature_c'))} AS avg_temp,
           {_r(_xmean('wind_speed_kmh'))} AS avg_wind,
           {_r(_xsum('precipitation_mm'))} AS total_precip
        FROM readings GROUP BY station_id, station_name"""
    )
    q["station_baseline"] = _readings(
        f"""SELECT station_id, {_r('mean_temp', 6)} AS mean_temp, {_r('std_temp', 6)} AS std_temp,
                  {_r('mean_wind', 6)} AS mean_wind, {_r('std_wind', 6)} AS std_wind
           FROM ({BASELINE_SELECT}) b"""
    )
    q["sigma_outliers"] = _readings(OUTLIERS_SELECT)
    q["hourly_profile"] = _readings(HOURLY_SELECT)
    q["station_extremes"] = _readings(
        f"""SELECT station_id, station_name,
           {_r('MIN(temperature_c)')} AS record_low,
           {_r('MAX(temperature_c)')} AS record_high,
           {_r(_xmean('temperature_c'))} AS mean_temp,
           {_r('stddev_samp(temperature_c)')} AS stddev_temp
        FROM readings GROUP BY station_id, station_name"""
    )
    q["gusty_days"] = _readings(
        f"""SELECT station_name, "date", {_r('MAX(wind_speed_kmh)', 1)} AS max_gust,
                  {_n('COUNT(*)')} AS high_wind_readings
           FROM readings WHERE wind_speed_kmh > 40e0 GROUP BY station_name, "date" """
    )
    q["hottest_days"] = _daily(
        """SELECT station_name, "date", max_temp FROM daily
           ORDER BY max_temp DESC, station_name, "date" LIMIT 5"""
    )
    q["monthly_trend"] = _readings(
        f"""SELECT month,
           {_r(_xmean('temperature_c'))} AS avg_temp,
           {_r('MIN(temperature_c)')} AS min_temp,
           {_r('MAX(temperature_c)')} AS max_temp,
           {_n('COUNT(*)')} AS total_readings
        FROM readings GROUP BY month"""
    )
    q["anomaly_leaderboard"] = _daily(
        f"""SELECT station_id, station_name, {_n('SUM(anomaly_count)')} AS total_anomalies,
                  {_r(_xmean('avg_temp'))} AS avg_daily_temp
           FROM daily GROUP BY station_id, station_name"""
    )
    q["rainy_days"] = _daily(
        """SELECT station_name, "date", total_precipitation, avg_temp, avg_humidity FROM daily
           WHERE total_precipitation > 5e0
           ORDER BY total_precipitation DESC, station_name, "date" LIMIT 20"""
    )
    q["station_conditions"] = _daily(
        f"""SELECT station_name,
           {_r(_xmean('avg_temp'))} AS overall_avg_temp,
           {_r(_xmean('avg_humidity'))} AS overall_avg_humidity,
           {_r(_xmean('avg_wind_speed'))} AS overall_avg_wind,
           {_r(_xsum('total_precipitation'))} AS total_rain,
           {_n('SUM(anomaly_count)')} AS total_anomalies
        FROM daily GROUP BY station_name"""
    )
    q["hourly_pattern_table"] = _readings(HOURLY_SELECT)
    q["day_over_day_change"] = _daily(
        f"""SELECT a.station_name, a."date" AS day, a.avg_temp AS current_avg, b.avg_temp AS previous_avg,
                  {_r('a.avg_temp - b.avg_temp')} AS temp_change
           FROM daily a JOIN daily b ON a.station_id = b.station_id AND a."date" = b."date" + 1
           WHERE abs(a.avg_temp - b.avg_temp) > 5e0
           ORDER BY abs(temp_change) DESC, a.station_name, day LIMIT 20"""
    )
    q["alerts"] = _readings(ALERTS_SELECT)
    q["sliding_window_stats"] = _readings(WINDOWS_SELECT)
    q["feed_summary"] = _readings(
        f"""SELECT {_n('COUNT(*)')} AS message_count,
                  {_n('COUNT(DISTINCT station_id) + coalesce(MAX(CAST(station_id IS NULL AS INTEGER)), 0)')}
                      AS station_count,
                  {_n('COUNT(*) FILTER (WHERE coalesce(is_anomaly, false))')} AS anomaly_count,
                  coalesce({_r(_xmean('coalesce(temperature_c, 0e0)'))}, 0e0) AS avg_temp
           FROM readings"""
    )
    q["run_summary"] = _with(READINGS_CTE, DAILY_CTE, f"outliers AS ({OUTLIERS_SELECT})") + """
           SELECT 'total_records' AS metric, CAST(COUNT(*) AS BIGINT) AS value FROM readings
           UNION ALL SELECT 'daily_rows', CAST(COUNT(*) AS BIGINT) FROM daily
           UNION ALL SELECT 'outliers_detected', CAST(COUNT(*) AS BIGINT) FROM outliers"""
    q["contract_report"] = _readings(
        f"""SELECT rule, checked, violations FROM (
          SELECT 1 AS o, 'required_fields' AS rule, {_n('COUNT(*)')} AS checked,
                 {_n('''COUNT(*) FILTER (WHERE station_id IS NULL OR station_name IS NULL OR latitude IS NULL
                    OR longitude IS NULL OR "timestamp" IS NULL OR temperature_c IS NULL
                    OR humidity_pct IS NULL OR pressure_hpa IS NULL OR wind_speed_kmh IS NULL
                    OR wind_direction IS NULL OR precipitation_mm IS NULL OR is_anomaly IS NULL)''')}
                 AS violations FROM readings
          UNION ALL SELECT 2, 'temperature_range', {_n('COUNT(temperature_c)')},
                 {_n('COUNT(*) FILTER (WHERE temperature_c <= -50e0 OR temperature_c >= 70e0)')} FROM readings
          UNION ALL SELECT 3, 'humidity_range', {_n('COUNT(humidity_pct)')},
                 {_n('COUNT(*) FILTER (WHERE humidity_pct < 10e0 OR humidity_pct > 100e0)')} FROM readings
          UNION ALL SELECT 4, 'wind_non_negative', {_n('COUNT(wind_speed_kmh)')},
                 {_n('COUNT(*) FILTER (WHERE wind_speed_kmh < 0e0)')} FROM readings
          UNION ALL SELECT 5, 'wind_direction_valid', {_n('COUNT(wind_direction)')},
                 {_n("COUNT(*) FILTER (WHERE wind_direction NOT IN ('N','NE','E','SE','S','SW','W','NW'))")}
                 FROM readings
          UNION ALL SELECT 6, 'precipitation_non_negative', {_n('COUNT(precipitation_mm)')},
                 {_n('COUNT(*) FILTER (WHERE precipitation_mm < 0e0)')} FROM readings
          UNION ALL SELECT 7, 'timestamp_format', {_n('COUNT("timestamp")')}, CAST(0 AS BIGINT) FROM readings
        ) t"""
    )
    q["anomaly_rate"] = _readings(
        f"""SELECT station_id, station_name, readings, anomalies,
                  anomalies / readings AS anomaly_rate,
                  (anomalies / readings > 0.005e0 AND anomalies / readings < 0.05e0) AS within_band
           FROM (SELECT station_id, station_name, {_n('COUNT(*)')} AS readings,
                        {_n('COUNT(*) FILTER (WHERE coalesce(is_anomaly, false))')} AS anomalies
                 FROM readings GROUP BY station_id, station_name) t"""
    )

    def _slice(pred: str) -> str:
        return _xmean(f"CASE WHEN {pred} THEN temperature_c END")

    q["diurnal_contrast"] = _readings(
        f"""SELECT station_id, station_name,
                  {_r('a')} AS afternoon_avg, {_r('n')} AS night_avg, {_r('a - n')} AS diurnal_delta,
                  {_r('s')} AS summer_avg, {_r('w')} AS winter_avg, {_r('s - w')} AS seasonal_delta
           FROM (SELECT station_id, station_name,
                        {_slice('hour = 14')} AS a, {_slice('hour = 3')} AS n,
                        {_slice('month = 7')} AS s, {_slice('month = 1')} AS w
                 FROM readings GROUP BY station_id, station_name) t"""
    )
    q["cadence_gaps"] = _with(READINGS_CTE) + f"""
        , counts AS (
          SELECT station_id, "date", {_n('COUNT(*)')} AS n FROM readings GROUP BY station_id, "date"
        ), calendar AS (
          SELECT station_id, CAST(unnest(generate_series(MIN("date"), MAX("date"), INTERVAL 1 DAY)) AS DATE) AS "date"
          FROM counts GROUP BY station_id
        )
        SELECT station_id, "date", coalesce(n, 0) AS readings, CAST(96 AS BIGINT) AS expected_readings,
               coalesce(n, 0) - 96 AS deviation
        FROM calendar LEFT JOIN counts USING (station_id, "date") WHERE coalesce(n, 0) <> 96"""
    # Round trips: what goes in must come back.
    for key in ("csv_roundtrip", "parquet_roundtrip", "warehouse_roundtrip"):
        q[key] = q["enriched_readings"]
    q["decoded_payloads"] = _readings(f'SELECT {WIRE_COLUMNS_SQL}, "timestamp" AS event_time FROM readings')
    q["encoded_payloads"] = _readings(
        f"""SELECT to_json(struct_pack(station_id := station_id, station_name := station_name,
                  latitude := latitude, longitude := longitude, "timestamp" := {WIRE_TS},
                  temperature_c := temperature_c, humidity_pct := humidity_pct, pressure_hpa := pressure_hpa,
                  wind_speed_kmh := wind_speed_kmh, wind_direction := wind_direction,
                  precipitation_mm := precipitation_mm, is_anomaly := is_anomaly)) AS value
           FROM readings"""
    )
    # Streams: the batch form of the same operator.
    q["alerts_stream"] = q["alerts"]
    q["sliding_window_stream"] = q["sliding_window_stats"]
    q["closed_windows_stream"] = _readings(
        f"""SELECT * FROM ({WINDOWS_SELECT}) w
           WHERE window_end <= (SELECT MAX("timestamp") FROM readings) - INTERVAL 10 MINUTE"""
    )
    q["raw_archive_stream"] = _readings(
        """SELECT station_id, station_name, "timestamp" AS event_time, temperature_c, humidity_pct,
                  pressure_hpa, wind_speed_kmh, precipitation_mm FROM readings"""
    )
    return q
