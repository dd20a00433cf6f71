"""Demand-response and health queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattspark.operators import demand_response as dr
from wattspark.operators import health
from wattspark.plans.projections import events, readings
from wattspark.plans.registry import query

AS_OF = "2024-01-30"
EVENT = ("2024-01-30", 14, 18)
DAYS = 29

SLOT = (
    "pole_id, CAST(extract(hour FROM event_ts) AS BIGINT) AS hour_of_day, "
    "CAST(extract(minute FROM event_ts) // 5 * 5 AS BIGINT) AS minute_bucket"
)
HISTORY = f"""history AS (
  SELECT {SLOT}, dayofweek(event_ts) + 1 AS day_of_week, CAST(event_ts AS DATE) AS event_date,
    sum(power_kw) AS total_power_kw, count(DISTINCT meter_id) AS meter_count
  FROM readings WHERE event_ts >= TIMESTAMP '2024-01-01' AND event_ts < TIMESTAMP '2024-01-30'
    AND dayofweek(event_ts) NOT IN (0, 6) GROUP BY ALL)"""


def baseline_cte(extra: str = "") -> str:
    return f"""baseline AS (
  SELECT pole_id, hour_of_day, minute_bucket,
    printf('%02d:%02d', hour_of_day, minute_bucket) AS time_of_day,
    avg(total_power_kw) AS baseline_avg_kw, quantile_disc(total_power_kw, 0.5) AS baseline_median_kw,
    quantile_disc(total_power_kw, 0.1) AS baseline_p10_kw,
    quantile_disc(total_power_kw, 0.9) AS baseline_p90_kw,
    stddev_samp(total_power_kw) AS baseline_stddev_kw,
    CAST(round(avg(meter_count)) AS BIGINT) AS avg_meter_count,
    count(DISTINCT event_date) AS baseline_days_count, TIMESTAMP '2024-01-30' AS computed_at
  FROM history {extra} GROUP BY pole_id, hour_of_day, minute_bucket)"""


BASE_DOUBLES = (
    "baseline_avg_kw baseline_median_kw baseline_p10_kw baseline_p90_kw baseline_stddev_kw"
)
ACTUAL = f"""actual AS (
  SELECT {SLOT}, sum(power_kw) AS actual_power_kw FROM readings
  WHERE event_ts >= TIMESTAMP '2024-01-30 14:00:00' AND event_ts < TIMESTAMP '2024-01-30 18:00:00'
  GROUP BY ALL)"""
CTES = (HISTORY, baseline_cte(), ACTUAL)


def _baseline(spark, sf_dir, holidays=None):
    return dr.baseline(readings(spark, sf_dir), AS_OF, DAYS, f"{AS_OF} 00:00:00", holidays)


@query(
    "a12_historical_load",
    "SELECT * FROM history",
    "total_power_kw",
    (HISTORY,),
)
def historical_load(spark, sf_dir):
    return dr.historical_load(readings(spark, sf_dir), AS_OF, DAYS)


@query("a13_baseline", "SELECT * FROM baseline", BASE_DOUBLES, (HISTORY, baseline_cte()))
def baseline(spark, sf_dir):
    return _baseline(spark, sf_dir)


HOLIDAYS = "(SELECT CAST(ts AS DATE) AS d FROM events GROUP BY ALL HAVING count(*) FILTER (event_type = 'error') * 5 > count(*))"


@query(
    "j07_baseline_without_holidays",
    "SELECT * FROM baseline",
    BASE_DOUBLES,
    (HISTORY, baseline_cte(f"WHERE event_date NOT IN {HOLIDAYS}")),
)
def baseline_without_holidays(spark, sf_dir):
    """Holidays derived from the table: days on which over a fifth of events are errors."""
    days = events(spark, sf_dir).groupBy(F.to_date("ts").alias("event_date"))
    errors = F.count_if(F.col("event_type") == "error")
    holidays = days.agg((errors * 5 > F.count(F.lit(1))).alias("h")).filter("h").drop("h")
    return _baseline(spark, sf_dir, holidays)


@query(
    "j02_load_left_join_baseline",
    "SELECT pole_id, hour_of_day, minute_bucket, actual_power_kw, baseline_avg_kw, baseline_median_kw, "
    "baseline_avg_kw - actual_power_kw AS load_reduction_kw, "
    "(baseline_avg_kw - actual_power_kw) / nullif(baseline_avg_kw, 0) * 100 AS reduction_percent "
    "FROM actual LEFT JOIN baseline USING (pole_id, hour_of_day, minute_bucket)",
    "actual_power_kw baseline_avg_kw baseline_median_kw load_reduction_kw reduction_percent",
    CTES,
)
def load_left_join(spark, sf_dir):
    load = dr.event_load(readings(spark, sf_dir), *EVENT)
    return dr.load_against_baseline(load, _baseline(spark, sf_dir))


@query(
    "a14_event_performance",
    "SELECT pole_id, sum(actual_power_kw) / count(*) AS avg_actual_kw, sum(baseline_avg_kw) / count(*) AS avg_baseline_kw, "
    "sum(baseline_avg_kw - actual_power_kw) / count(*) AS avg_reduction_kw, "
    "avg((baseline_avg_kw - actual_power_kw) / nullif(baseline_avg_kw, 0) * 100) AS avg_reduction_percent, "
    "sum(baseline_avg_kw - actual_power_kw) / 12 AS total_reduction_kwh "
    "FROM actual LEFT JOIN baseline USING (pole_id, hour_of_day, minute_bucket) "
    "GROUP BY pole_id ORDER BY avg_reduction_percent DESC NULLS LAST",
    "avg_actual_kw avg_baseline_kw avg_reduction_kw avg_reduction_percent total_reduction_kwh",
    CTES,
)
def event_performance(spark, sf_dir):
    return dr.event_performance(readings(spark, sf_dir), _baseline(spark, sf_dir), *EVENT)


POLES = ("pole_0", "pole_2", "pole_5", "pole_9")
COMPUTED = """computed AS (
  SELECT pole_id, CAST(round(CAST(avg(actual_power_kw) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS avg_actual_kw, CAST(round(CAST(avg(kw) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS avg_baseline_kw,
    CAST(round(CAST(avg(kw - actual_power_kw) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS avg_reduction_kw,
    CAST(round(CAST(coalesce(avg(kw - actual_power_kw) / nullif(avg(kw), 0) * 100, 0) AS DECIMAL(28, 9)), 2) AS DOUBLE) AS reduction_percent,
    CAST(round(CAST(sum(kw - actual_power_kw) / 12 AS DECIMAL(28, 9)), 3) AS DOUBLE) AS total_reduction_kwh
  FROM (SELECT *, coalesce(baseline_avg_kw, 0) AS kw FROM actual
    LEFT JOIN baseline USING (pole_id, hour_of_day, minute_bucket)) AS filled
  WHERE pole_id IN ('pole_0', 'pole_2', 'pole_5', 'pole_9') GROUP BY pole_id)"""


def _computed(spark, sf_dir):
    return dr.compute_event(readings(spark, sf_dir), _baseline(spark, sf_dir), POLES, *EVENT)


@query("a15_compute_event", "SELECT * FROM computed ORDER BY total_reduction_kwh DESC", "", (*CTES, COMPUTED))
def compute_event(spark, sf_dir):
    return _computed(spark, sf_dir)


@query(
    "j03_load_left_join_zero_filled",
    "SELECT pole_id, hour_of_day, minute_bucket, actual_power_kw, coalesce(baseline_avg_kw, 0) AS baseline_kw "
    "FROM actual LEFT JOIN baseline USING (pole_id, hour_of_day, minute_bucket)",
    "actual_power_kw baseline_kw",
    CTES,
)
def zero_filled(spark, sf_dir):
    load = dr.event_load(readings(spark, sf_dir), *EVENT)
    joined = dr.load_against_baseline(load, _baseline(spark, sf_dir))
    return joined.select(
        *dr.SLOT,
        "actual_power_kw",
        F.coalesce("baseline_avg_kw", F.lit(0.0)).alias("baseline_kw"),
    )


@query(
    "a16_event_total",
    "SELECT count(*) AS poles, CAST(round(CAST(coalesce(sum(total_reduction_kwh), 0) AS DECIMAL(28, 9)), 3) AS DOUBLE) AS total_reduction_kwh FROM computed",
    "",
    (*CTES, COMPUTED),
)
def event_total(spark, sf_dir):
    return dr.event_total(_computed(spark, sf_dir))


@query(
    "t08_poles_by_reduction",
    "SELECT pole_id, total_reduction_kwh FROM computed ORDER BY total_reduction_kwh DESC",
    "",
    (*CTES, COMPUTED),
)
def poles_by_reduction(spark, sf_dir):
    return _computed(spark, sf_dir).select("pole_id", "total_reduction_kwh")


METRICS = """metrics AS (
  SELECT pole_id, CAST(event_ts AS DATE) AS event_date, CAST(extract(hour FROM event_ts) AS BIGINT) AS hour_of_day,
    count(*) AS total_readings, count(DISTINCT meter_id) AS active_meters, avg(voltage_v) AS avg_voltage_v,
    min(voltage_v) AS min_voltage_v, max(voltage_v) AS max_voltage_v, stddev_samp(voltage_v) AS voltage_stddev,
    count(*) FILTER (voltage_v < 220) AS low_voltage_count, count(*) FILTER (voltage_v > 260) AS high_voltage_count,
    count(*) FILTER (len(quality_flags) > 0) AS flagged_readings, sum(power_kw) AS total_power_kw,
    avg(power_kw) AS avg_power_per_meter_kw, max(power_kw) AS peak_meter_power_kw,
    sum(reactive_kvar) AS total_reactive_kvar, avg(freq_hz) AS avg_freq_hz, min(freq_hz) AS min_freq_hz,
    max(freq_hz) AS max_freq_hz
  FROM readings GROUP BY ALL)"""
HEALTH = """health AS (
  SELECT pole_id, event_date, hour_of_day, active_meters, total_readings,
    active_meters * 3600 AS expected_readings,
    CAST(round(CAST(total_readings / (active_meters * 3600) * 100 AS DECIMAL(28, 9)), 2) AS DOUBLE) AS data_completeness_pct,
    active_meters * 3600 - total_readings AS missing_readings, avg_voltage_v, min_voltage_v, max_voltage_v,
    voltage_stddev AS voltage_volatility, CAST(round(CAST(low_voltage_count / total_readings * 100 AS DECIMAL(28, 9)), 2) AS DOUBLE) AS low_voltage_pct,
    CAST(round(CAST(high_voltage_count / total_readings * 100 AS DECIMAL(28, 9)), 2) AS DOUBLE) AS high_voltage_pct, total_power_kw,
    avg_power_per_meter_kw, peak_meter_power_kw,
    total_power_kw / nullif(sqrt(total_power_kw ** 2 + total_reactive_kvar ** 2), 0) AS estimated_power_factor,
    avg_freq_hz, max_freq_hz - min_freq_hz AS freq_range_hz,
    CASE WHEN voltage_stddev IS NOT NULL THEN CAST(round(CAST(
      CASE WHEN total_readings >= active_meters * 3600 THEN 25 ELSE total_readings / (active_meters * 3600) * 25 END
      + (1 - (low_voltage_count + high_voltage_count) / total_readings) * 50
      + CASE WHEN voltage_stddev > 10 THEN 0 ELSE (1 - voltage_stddev / 10) * 25 END AS DECIMAL(28, 9)), 1) AS DOUBLE) END AS health_score
  FROM metrics)"""
METRIC_DOUBLES = (
    "avg_voltage_v min_voltage_v max_voltage_v voltage_stddev total_power_kw avg_power_per_meter_kw "
    "peak_meter_power_kw total_reactive_kvar avg_freq_hz min_freq_hz max_freq_hz"
)
HEALTH_DOUBLES = (
    "avg_voltage_v min_voltage_v max_voltage_v voltage_volatility total_power_kw avg_power_per_meter_kw "
    "peak_meter_power_kw estimated_power_factor avg_freq_hz freq_range_hz"
)


@query("a17_hourly_metrics", "SELECT * FROM metrics", METRIC_DOUBLES, (METRICS,))
def hourly_metrics(spark, sf_dir):
    return health.hourly_metrics(readings(spark, sf_dir))


@query(
    "j01_hourly_metrics_join_expected",
    "SELECT m.*, e.expected_readings FROM metrics m JOIN (SELECT pole_id, event_date, hour_of_day, "
    "active_meters * 3600 AS expected_readings FROM metrics) e USING (pole_id, event_date, hour_of_day)",
    METRIC_DOUBLES,
    (METRICS,),
)
def join_expected(spark, sf_dir):
    return health.with_expected_readings_joined(health.hourly_metrics(readings(spark, sf_dir)))


@query("a18_hourly_health", "SELECT * FROM health", HEALTH_DOUBLES, (METRICS, HEALTH))
def hourly_health(spark, sf_dir):
    return health.hourly_health(readings(spark, sf_dir))


@query(
    "a18_hourly_health_last_day",
    "SELECT * FROM health WHERE event_date >= DATE '2024-01-30' ORDER BY pole_id, event_date, hour_of_day",
    HEALTH_DOUBLES,
    (METRICS, HEALTH),
)
def hourly_health_last_day(spark, sf_dir):
    report = health.hourly_health(readings(spark, sf_dir), "2024-01-31 00:00:00", 24)
    return report.orderBy(*health.HOURLY)


DAILY_HEALTH = (
    "SELECT pole_id, event_date, max(active_meters) AS max_active_meters, avg(active_meters) AS avg_active_meters, "
    "CAST(sum(total_readings) AS BIGINT) AS total_readings, CAST(sum(expected_readings) AS BIGINT) AS expected_readings, "
    "CAST(round(CAST(sum(total_readings) / nullif(sum(expected_readings), 0) * 100 AS DECIMAL(28, 9)), 2) AS DOUBLE) AS data_completeness_pct, "
    "avg(avg_voltage_v) AS daily_avg_voltage_v, min(min_voltage_v) AS daily_min_voltage_v, "
    "max(max_voltage_v) AS daily_max_voltage_v, avg(low_voltage_pct) AS avg_low_voltage_pct, "
    "max(low_voltage_pct) AS peak_low_voltage_hour_pct, sum(total_power_kw) / 24 AS avg_hourly_power_kw, "
    "max(total_power_kw) AS peak_hour_power_kw, avg(health_score) AS avg_health_score, "
    "min(health_score) AS min_health_score, count(*) FILTER (health_score < 70) AS problem_hours_count "
    "FROM health GROUP BY pole_id, event_date"
)
DAILY_DOUBLES = (
    "avg_active_meters daily_avg_voltage_v daily_min_voltage_v daily_max_voltage_v avg_low_voltage_pct "
    "avg_hourly_power_kw peak_hour_power_kw avg_health_score"
)


@query(
    "a19_daily_health",
    DAILY_HEALTH + " ORDER BY pole_id, event_date",
    DAILY_DOUBLES,
    (METRICS, HEALTH),
)
def daily_health(spark, sf_dir):
    daily = health.daily_health(health.hourly_health(readings(spark, sf_dir)))
    return daily.orderBy("pole_id", "event_date")


@query(
    "t06_health_alerts",
    "SELECT pole_id, event_date, hour_of_day, health_score, data_completeness_pct, low_voltage_pct, avg_voltage_v, "
    "min_voltage_v, CASE WHEN health_score < 50 THEN 'CRITICAL' WHEN health_score < 70 THEN 'WARNING' ELSE 'OK' END "
    "AS alert_level FROM health WHERE health_score < 70 "
    "ORDER BY health_score, event_date DESC, hour_of_day DESC, pole_id LIMIT 100",
    "avg_voltage_v min_voltage_v",
    (METRICS, HEALTH),
)
def health_alerts(spark, sf_dir):
    return health.health_alerts(health.hourly_health(readings(spark, sf_dir)))


@query(
    "s04_view_over_hourly_health",
    "SELECT pole_id, event_date, hour_of_day, health_score FROM health WHERE health_score < 70",
    "",
    (METRICS, HEALTH),
)
def view_over_health(spark, sf_dir):
    health.hourly_health(readings(spark, sf_dir)).createOrReplaceTempView("pole_health_hourly")
    return spark.sql(
        "SELECT pole_id, event_date, hour_of_day, health_score FROM pole_health_hourly "
        "WHERE health_score < :limit",
        args={"limit": 70.0},
    )


@query(
    "f12_scores_side_by_side",
    "SELECT pole_id, count(*) FILTER (voltage_v BETWEEN 220 AND 260) / count(*) * 100 AS gauge_score, "
    "CAST(round(CAST((1 - count(*) FILTER (voltage_v < 220 OR voltage_v > 260) / count(*)) * 100 AS DECIMAL(28, 9)), 1) AS DOUBLE) AS summary_score "
    "FROM readings GROUP BY pole_id",
    "gauge_score",
)
def scores(spark, sf_dir):
    from wattspark.functions.quality import normal_share_gauge, normal_share_score

    rows, volts = readings(spark, sf_dir), F.col("voltage_v")
    return rows.groupBy("pole_id").agg(
        normal_share_gauge(volts).alias("gauge_score"),
        normal_share_score(volts).alias("summary_score"),
    )
