"""Pole gauges and dashboard series."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattspark.operators import dashboard, gauges
from wattspark.plans.projections import readings
from wattspark.plans.registry import query

GAUGES = (
    "avg(voltage_v) AS voltage_avg, min(voltage_v) AS voltage_min, max(voltage_v) AS voltage_max, "
    "sum(power_kw) AS power_total_kw, count(*) FILTER (voltage_v < 220) AS voltage_sag_count, "
    "count(*) FILTER (voltage_v BETWEEN 220 AND 260) / count(*) * 100 AS health_score, "
    "count(DISTINCT meter_id) AS active_meter_count"
)
DOUBLES = "voltage_avg voltage_min voltage_max power_total_kw health_score"
MINUTE = (
    f"gauges AS (SELECT pole_id, date_trunc('minute', event_ts) + INTERVAL 1 MINUTE AS end_time, {GAUGES} "
    "FROM readings GROUP BY ALL)"
)
LONG = """series AS (
  SELECT * FROM (SELECT pole_id, end_time, voltage_avg, voltage_min, voltage_max, power_total_kw,
      CAST(voltage_sag_count AS DOUBLE) AS voltage_sag_count, health_score,
      CAST(active_meter_count AS DOUBLE) AS active_meter_count FROM gauges)
  UNPIVOT (value FOR metric IN (voltage_avg, voltage_min, voltage_max, power_total_kw, voltage_sag_count,
    health_score, active_meter_count)))"""


def _series(spark, sf_dir):
    return gauges.to_series(gauges.pole_gauges(readings(spark, sf_dir), 60))


@query("a02_pole_gauges", "SELECT * FROM gauges", DOUBLES, (MINUTE,))
def pole_gauges(spark, sf_dir):
    return gauges.pole_gauges(readings(spark, sf_dir), 60)


@query(
    "a03_gauge_series",
    "SELECT metric, pole_id, end_time, value, CASE WHEN metric IN ('voltage_sag_count', 'active_meter_count') "
    "THEN 'int64' ELSE 'double' END AS value_type FROM series",
    "value",
    (MINUTE, LONG),
)
def gauge_series(spark, sf_dir):
    return _series(spark, sf_dir).select(
        "metric", F.col("labels")["pole_id"].alias("pole_id"), "end_time", "value", "value_type"
    )


@query(
    "a04_batch_gauges",
    f"SELECT pole_id, TIMESTAMP '2024-01-31' AS end_time, {GAUGES} FROM readings GROUP BY pole_id",
    DOUBLES,
)
def batch_gauges(spark, sf_dir):
    return gauges.batch_gauges(readings(spark, sf_dir), "2024-01-31 00:00:00")


@query(
    "st06_unknown_pole",
    "SELECT coalesce(CASE WHEN network_profile IS NOT NULL THEN pole_id END, 'unknown') AS pole_id, "
    f"TIMESTAMP '2024-01-31' AS end_time, {GAUGES} FROM readings GROUP BY ALL",
    DOUBLES,
)
def unknown_pole(spark, sf_dir):
    """Readings without a network profile lose their pole first."""
    known = F.when(F.col("network_profile").isNotNull(), F.col("pole_id"))
    rows = readings(spark, sf_dir).withColumn("pole_id", known)
    return gauges.batch_gauges(rows, "2024-01-31 00:00:00")


def _aligned(metric: str, seconds: int, how: str) -> str:
    return (
        f"(SELECT time_bucket(INTERVAL {seconds} SECONDS, end_time) AS period_start, pole_id, {how}(value) AS value "
        f"FROM series WHERE metric = '{metric}' GROUP BY ALL) AS aligned"
    )


@query("d01_average_voltage", f"SELECT * FROM {_aligned('voltage_avg', 60, 'avg')}", "value", (MINUTE, LONG))
def average_voltage(spark, sf_dir):
    return dashboard.align(_series(spark, sf_dir), "voltage_avg", "mean", 60)


@query("d01_total_power", f"SELECT * FROM {_aligned('power_total_kw', 60, 'avg')}", "value", (MINUTE, LONG))
def total_power(spark, sf_dir):
    return dashboard.align(_series(spark, sf_dir), "power_total_kw", "mean", 60)


@query(
    "d02_sag_events",
    f"SELECT period_start, sum(value) AS value FROM {_aligned('voltage_sag_count', 300, 'sum')} GROUP BY ALL",
    "value",
    (MINUTE, LONG),
)
def sag_tile(spark, sf_dir):
    return dashboard.align_and_reduce(_series(spark, sf_dir), "voltage_sag_count", "sum", "sum", 300)


@query(
    "d03_health_score",
    f"SELECT period_start, avg(value) AS value FROM {_aligned('health_score', 60, 'avg')} GROUP BY ALL",
    "value",
    (MINUTE, LONG),
)
def health_tile(spark, sf_dir):
    return dashboard.align_and_reduce(_series(spark, sf_dir), "health_score", "mean", "mean", 60)


@query(
    "d04_active_meters",
    f"SELECT period_start, sum(value) AS value FROM {_aligned('active_meter_count', 60, 'avg')} GROUP BY ALL",
    "value",
    (MINUTE, LONG),
)
def meters_tile(spark, sf_dir):
    return dashboard.align_and_reduce(
        _series(spark, sf_dir), "active_meter_count", "mean", "sum", 60
    )


@query(
    "d05_voltage_distribution",
    "SELECT end_time AS period_start, pole_id, voltage_min, voltage_avg, voltage_max FROM gauges",
    "voltage_min voltage_avg voltage_max",
    (MINUTE,),
)
def distribution_tile(spark, sf_dir):
    return dashboard.voltage_distribution(_series(spark, sf_dir))


@query(
    "d06_ingest_rate",
    "SELECT date_trunc('minute', ingest_ts) AS period_start, count(*) / 60 AS rate_per_second FROM readings GROUP BY ALL",
    "rate_per_second",
)
def rate_tile(spark, sf_dir):
    return dashboard.arrival_rate(readings(spark, sf_dir))


LAG = (
    "SELECT date_trunc('minute', ingest_ts) AS period_start, "
    "max(epoch_us(ingest_ts) - epoch_us(event_ts)) / 1000000 AS lag_seconds FROM readings GROUP BY ALL"
)


@query("d07_processing_lag", LAG, "lag_seconds")
def lag_tile(spark, sf_dir):
    return dashboard.processing_lag(readings(spark, sf_dir))


@query(
    "d08_lag_state",
    "SELECT period_start, CASE WHEN lag_seconds > 120 THEN 'RED' WHEN lag_seconds > 30 THEN 'YELLOW' "
    f"ELSE 'GREEN' END AS state FROM ({LAG})",
)
def lag_state(spark, sf_dir):
    lag = dashboard.processing_lag(readings(spark, sf_dir))
    state = dashboard.tile_state(F.col("lag_seconds"), "processing_lag")
    return lag.select("period_start", state.alias("state"))


@query(
    "d08_health_state",
    "SELECT period_start, CASE WHEN value < 80 THEN 'RED' WHEN value < 95 THEN 'YELLOW' ELSE 'GREEN' END AS state "
    f"FROM (SELECT period_start, avg(value) AS value FROM {_aligned('health_score', 60, 'avg')} GROUP BY ALL)",
    "",
    (MINUTE, LONG),
)
def health_state(spark, sf_dir):
    tile = health_tile(spark, sf_dir)
    state = dashboard.tile_state(F.col("value"), "health_score")
    return tile.select("period_start", state.alias("state"))


@query(
    "d08_sag_state",
    "SELECT bucket AS period_start, CASE WHEN n > 20 THEN 'RED' WHEN n > 5 THEN 'YELLOW' ELSE 'GREEN' END AS state "
    "FROM (SELECT time_bucket(INTERVAL 5 MINUTES, date_trunc('minute', event_ts) + INTERVAL 1 MINUTE) AS bucket, "
    "count(*) FILTER (voltage_v < 220) AS n FROM readings GROUP BY ALL)",
)
def sag_state(spark, sf_dir):
    tile = sag_tile(spark, sf_dir)
    state = dashboard.tile_state(F.col("value"), "voltage_sag_count")
    return tile.select("period_start", state.alias("state"))


@query(
    "d08_backlog_state",
    "SELECT d AS event_date, n AS backlog, CASE WHEN n > 1000 THEN 'RED' WHEN n > 100 THEN 'YELLOW' ELSE 'GREEN' END AS state "
    "FROM (SELECT CAST(event_ts AS DATE) AS d, count(*) FILTER (CAST(ingest_ts AS DATE) > CAST(event_ts AS DATE)) AS n "
    "FROM readings GROUP BY ALL)",
)
def backlog_state(spark, sf_dir):
    """Backlog at midnight: readings of a day that had not arrived by its end."""
    late = F.to_date("ingest_ts") > F.to_date("event_ts")
    days = readings(spark, sf_dir).groupBy(F.to_date("event_ts").alias("event_date"))
    counted = days.agg(F.count_if(late).alias("backlog"))
    return counted.withColumn("state", dashboard.tile_state(F.col("backlog"), "backlog"))


@query(
    "d08_voltage_band",
    "SELECT pole_id, end_time AS period_start, CASE WHEN voltage_avg < 220 THEN 'BELOW_LIMIT' "
    "WHEN voltage_avg < 240 THEN 'BELOW_NOMINAL' ELSE 'NOMINAL' END AS band FROM gauges",
    "",
    (MINUTE,),
)
def voltage_band(spark, sf_dir):
    tile = average_voltage(spark, sf_dir)
    return tile.select(
        "pole_id", "period_start", dashboard.voltage_band(F.col("value")).alias("band")
    )
