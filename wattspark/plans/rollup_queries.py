"""Filters, rollups, quick looks and top-k reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattspark.operators import filters, rollups
from wattspark.operators.delivery import derive_flags
from wattspark.plans.projections import numbered_readings, readings
from wattspark.plans.registry import query

AS_OF = "2024-01-31 00:00:00"
LAST_DAY = "event_ts >= TIMESTAMP '2024-01-30 00:00:00'"

BUCKET = "CAST(extract(minute FROM event_ts) // 5 * 5 AS BIGINT)"
HOUR = "CAST(extract(hour FROM event_ts) AS BIGINT)"


@query(
    "s02_readings_scan",
    "SELECT event_ts, ingest_ts, meter_id, pole_id, seq, voltage_v, current_a, power_kw, reactive_kvar, "
    "freq_hz, array_to_string(quality_flags, ',') AS quality_flags, network_profile FROM readings",
    "voltage_v current_a power_kw reactive_kvar freq_hz",
)
def scan(spark, sf_dir):
    return readings(spark, sf_dir)


@query(
    "p17_quality_flags",
    "SELECT meter_id, event_ts, CASE WHEN voltage_v < 220 THEN 'voltage_sag' "
    "WHEN voltage_v > 260 THEN 'voltage_swell' ELSE '' END AS quality_flags FROM readings",
)
def quality_flags(spark, sf_dir):
    return derive_flags(readings(spark, sf_dir)).select("meter_id", "event_ts", "quality_flags")


@query(
    "p19_since_date",
    "SELECT meter_id, event_ts FROM readings WHERE CAST(event_ts AS DATE) >= DATE '2024-01-31' - 1",
)
def since_date(spark, sf_dir):
    return filters.since_date(readings(spark, sf_dir), "2024-01-31", 1).select("meter_id", "event_ts")


@query(
    "p20_since_timestamp",
    "SELECT meter_id, event_ts FROM readings WHERE event_ts >= TIMESTAMP '2024-01-31' - INTERVAL 36 HOURS",
)
def since_timestamp(spark, sf_dir):
    return filters.since(readings(spark, sf_dir), AS_OF, 36 * 3600).select("meter_id", "event_ts")


@query(
    "p21_closed_range_of_pole",
    "SELECT meter_id, event_ts FROM readings WHERE pole_id = 'pole_3' "
    "AND event_ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'",
)
def closed_range(spark, sf_dir):
    rows = filters.within(readings(spark, sf_dir), "2024-01-10 00:00:00", "2024-01-20 00:00:00")
    return filters.of_poles(rows, ["pole_3"]).select("meter_id", "event_ts")


@query(
    "p22_poles_on_weekdays",
    "SELECT meter_id, event_ts FROM readings WHERE pole_id IN ('pole_1', 'pole_4') "
    "AND dayofweek(event_ts) NOT IN (0, 6)",
)
def membership(spark, sf_dir):
    rows = filters.of_poles(readings(spark, sf_dir), ["pole_1", "pole_4"])
    return filters.weekdays(rows).select("meter_id", "event_ts")


@query(
    "p23_hour_range",
    f"SELECT meter_id, event_ts FROM readings WHERE {HOUR} BETWEEN 14 AND 17",
)
def hour_range(spark, sf_dir):
    return filters.hour_range(readings(spark, sf_dir), 14, 18).select("meter_id", "event_ts")


@query(
    "p24_lookback_days",
    "SELECT meter_id, event_ts FROM readings WHERE event_ts >= TIMESTAMP '2024-01-15' "
    "AND event_ts < TIMESTAMP '2024-01-25'",
)
def lookback(spark, sf_dir):
    return filters.lookback_days(readings(spark, sf_dir), "2024-01-25", 10).select(
        "meter_id", "event_ts"
    )


@query(
    "p25_filter_after_aggregate",
    "SELECT pole_id, count(*) AS readings FROM readings GROUP BY pole_id HAVING count(*) >= "
    "(SELECT count(*) / 10.0 FROM readings)",
)
def after_aggregate(spark, sf_dir):
    rows = readings(spark, sf_dir)
    per_pole = rows.groupBy("pole_id").agg(F.count(F.lit(1)).alias("readings"))
    tenth = rows.agg((F.count(F.lit(1)) / 10).alias("n"))
    return per_pole.filter(F.col("readings") >= tenth.scalar())


@query(
    "a09_minute_load_profile",
    f"SELECT pole_id, date_trunc('minute', event_ts) AS minute_ts, {BUCKET} AS minute_bucket, "
    f"CAST(event_ts AS DATE) AS event_date, {HOUR} AS hour_of_day, dayofweek(event_ts) + 1 AS day_of_week, "
    "count(*) AS reading_count, count(DISTINCT meter_id) AS meter_count, sum(power_kw) AS total_power_kw, "
    "avg(power_kw) AS avg_power_kw, max(power_kw) AS max_power_kw, avg(voltage_v) AS avg_voltage_v, "
    "min(voltage_v) AS min_voltage_v, max(voltage_v) AS max_voltage_v, stddev_samp(voltage_v) AS stddev_voltage_v, "
    "sum(current_a) AS total_current_a, avg(current_a) AS avg_current_a, "
    "sum(reactive_kvar) AS total_reactive_kvar, avg(freq_hz) AS avg_freq_hz FROM readings GROUP BY ALL",
    "total_power_kw avg_power_kw max_power_kw avg_voltage_v min_voltage_v max_voltage_v stddev_voltage_v "
    "total_current_a avg_current_a total_reactive_kvar avg_freq_hz",
)
def minute_load_profile(spark, sf_dir):
    return rollups.minute_load_profile(readings(spark, sf_dir))


POLE_MEASURES = (
    "count(*) AS reading_count, count(DISTINCT meter_id) AS meter_count, avg(voltage_v) AS avg_voltage_v, "
    "min(voltage_v) AS min_voltage_v, max(voltage_v) AS max_voltage_v, stddev_samp(voltage_v) AS stddev_voltage_v, "
    "avg(current_a) AS avg_current_a, sum(power_kw) AS total_power_kw, avg(power_kw) AS avg_power_kw, "
    "max(power_kw) AS peak_power_kw, avg(freq_hz) AS avg_freq_hz"
)
POLE_DOUBLES = (
    "avg_voltage_v min_voltage_v max_voltage_v stddev_voltage_v avg_current_a total_power_kw avg_power_kw "
    "peak_power_kw avg_freq_hz"
)


@query(
    "a10_pole_minute_view",
    f"SELECT pole_id, date_trunc('minute', event_ts) AS interval_start, {BUCKET} AS minute_bucket, "
    f"{POLE_MEASURES} FROM readings GROUP BY ALL",
    POLE_DOUBLES,
)
def pole_minute_view(spark, sf_dir):
    return rollups.pole_minute_view(readings(spark, sf_dir))


@query(
    "a11_five_minute_rollup",
    f"SELECT pole_id, time_bucket(INTERVAL 5 MINUTES, event_ts) AS interval_start, {POLE_MEASURES} "
    "FROM readings GROUP BY ALL",
    POLE_DOUBLES,
)
def five_minute_rollup(spark, sf_dir):
    return rollups.pole_interval_rollup(readings(spark, sf_dir), 5)


WINDOW_STATS = (
    "SELECT pole_id, date_trunc('minute', event_ts) AS window_start, count(*) AS reading_count, "
    "count(DISTINCT meter_id) AS meter_count, avg(voltage_v) AS avg_voltage_v, min(voltage_v) AS min_voltage_v, "
    "max(voltage_v) AS max_voltage_v, sum(power_kw) AS total_power_kw, avg(power_kw) AS avg_power_kw "
    "FROM readings GROUP BY ALL"
)
WINDOW_DOUBLES = "avg_voltage_v min_voltage_v max_voltage_v total_power_kw avg_power_kw"


@query("a01_pole_window_stats", WINDOW_STATS, WINDOW_DOUBLES)
def pole_window_stats(spark, sf_dir):
    return rollups.pole_window_stats(readings(spark, sf_dir), 60)


@query(
    "a20_pole_summary",
    "SELECT 'pole_3' AS pole_id, TIMESTAMP '2024-01-10' AS start_time, TIMESTAMP '2024-01-20' AS end_time, "
    "count(DISTINCT meter_id) AS meter_count, count(*) AS reading_count, CAST(round(CAST(avg(voltage_v) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS avg_voltage_v, "
    "CAST(round(CAST(min(voltage_v) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS min_voltage_v, CAST(round(CAST(max(voltage_v) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS max_voltage_v, "
    "CAST(round(CAST(coalesce(stddev_samp(voltage_v), 0) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS voltage_stddev, CAST(round(CAST(sum(power_kw) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS total_power_kw, "
    "CAST(round(CAST(avg(power_kw) AS DECIMAL(28, 9)), 3) AS DOUBLE) AS avg_power_kw, CAST(round(CAST(max(power_kw) AS DECIMAL(28, 9)), 3) AS DOUBLE) AS peak_power_kw, "
    "CAST(round(CAST(100.0 * count(*) FILTER (voltage_v < 220) / count(*) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS low_voltage_pct, "
    "CAST(round(CAST(100.0 * count(*) FILTER (voltage_v BETWEEN 220 AND 260) / count(*) AS DECIMAL(28, 9)), 1) AS DOUBLE) AS health_score "
    "FROM readings WHERE pole_id = 'pole_3' AND event_ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' "
    "HAVING count(*) > 0",
)
def pole_summary(spark, sf_dir):
    return rollups.pole_summary(
        readings(spark, sf_dir), "pole_3", "2024-01-10 00:00:00", "2024-01-20 00:00:00"
    )


@query("a21_count_last_day", f"SELECT count(*) AS total_readings FROM readings WHERE {LAST_DAY}")
def count_last_day(spark, sf_dir):
    return rollups.count_readings(readings(spark, sf_dir), AS_OF, 24)


@query("a21_count_all", "SELECT count(*) AS total_readings FROM readings")
def count_all(spark, sf_dir):
    return rollups.count_readings(readings(spark, sf_dir))


@query(
    "a22_stats_by_pole",
    "SELECT pole_id, count(DISTINCT meter_id) AS meters, count(*) AS readings, CAST(round(CAST(avg(voltage_v) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS avg_voltage, "
    "CAST(round(CAST(min(voltage_v) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS min_voltage, CAST(round(CAST(max(voltage_v) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS max_voltage, "
    "CAST(round(CAST(sum(power_kw) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS total_power_kw FROM readings "
    "WHERE event_ts >= TIMESTAMP '2024-01-30 23:00:00' GROUP BY pole_id ORDER BY pole_id",
)
def stats_by_pole(spark, sf_dir):
    return rollups.stats_by_pole(readings(spark, sf_dir), AS_OF, 1)


@query(
    "a23_readings_by_hour",
    "SELECT date_trunc('hour', event_ts) AS hour, count(*) AS readings, count(DISTINCT meter_id) AS meters "
    f"FROM readings WHERE {LAST_DAY} GROUP BY ALL ORDER BY hour DESC LIMIT 24",
)
def readings_by_hour(spark, sf_dir):
    return rollups.readings_by_hour(readings(spark, sf_dir), AS_OF)


@query(
    "t07_newest_hours_of_month",
    "SELECT date_trunc('hour', event_ts) AS hour, count(*) AS readings, count(DISTINCT meter_id) AS meters "
    "FROM readings GROUP BY ALL ORDER BY hour DESC LIMIT 24",
)
def newest_hours(spark, sf_dir):
    return rollups.readings_by_hour(readings(spark, sf_dir), AS_OF, 24 * 31)


@query(
    "a24_power_by_pole",
    "SELECT pole_id, count(*) AS readings, avg(voltage_v) AS avg_voltage, sum(power_kw) AS total_power "
    f"FROM readings WHERE {LAST_DAY} GROUP BY pole_id",
    "avg_voltage total_power",
)
def power_by_pole(spark, sf_dir):
    return rollups.power_by_pole(readings(spark, sf_dir), AS_OF, 24)


@query(
    "a25_active_poles",
    f"SELECT pole_id FROM readings WHERE {LAST_DAY} GROUP BY pole_id ORDER BY pole_id LIMIT 100",
)
def active_poles(spark, sf_dir):
    return rollups.active_poles(readings(spark, sf_dir), AS_OF)


@query(
    "t09_first_poles",
    f"SELECT pole_id FROM readings WHERE {LAST_DAY} GROUP BY pole_id ORDER BY pole_id LIMIT 3",
)
def first_poles(spark, sf_dir):
    return rollups.active_poles(readings(spark, sf_dir), AS_OF, limit=3)


@query(
    "t04_newest_readings",
    "SELECT event_ts, meter_id, pole_id, voltage_v, current_a, power_kw FROM readings "
    "ORDER BY event_ts DESC, meter_id, seq LIMIT 10",
    "voltage_v current_a power_kw",
)
def newest(spark, sf_dir):
    return rollups.newest_readings(readings(spark, sf_dir))


@query(
    "t04_newest_readings_rounded",
    "SELECT event_ts, meter_id, pole_id, CAST(round(CAST(voltage_v AS DECIMAL(28, 9)), 2) AS DOUBLE) AS voltage_v, CAST(round(CAST(power_kw AS DECIMAL(28, 9)), 3) AS DOUBLE) AS power_kw "
    "FROM readings ORDER BY event_ts DESC, meter_id, seq LIMIT 5",
)
def newest_rounded(spark, sf_dir):
    return rollups.newest_readings_rounded(readings(spark, sf_dir))


@query(
    "t05_newest_low_voltage",
    "SELECT meter_id, pole_id, event_ts, CAST(round(CAST(voltage_v AS DECIMAL(28, 9)), 2) AS DOUBLE) AS voltage_v FROM readings "
    "WHERE voltage_v < 220 ORDER BY event_ts DESC, meter_id, seq LIMIT 10",
)
def newest_low(spark, sf_dir):
    return rollups.newest_low_voltage(readings(spark, sf_dir))


@query(
    "st10_repeats_dropped_batch",
    "SELECT meter_id, event_id AS seq, event_ts, voltage_v FROM readings",
    "voltage_v",
)
def repeats_dropped(spark, sf_dir):
    """Every third reading comes twice; each stays once."""
    rows = numbered_readings(spark, sf_dir)
    twice = rows.unionByName(rows.filter(F.col("seq") % 3 == 0))
    return rollups.first_of_each(twice, ["meter_id", "seq"]).select(
        "meter_id", "seq", "event_ts", "voltage_v"
    )
