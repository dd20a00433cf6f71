"""Loss, latency, completeness, gaps and electrical consistency."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattspark.operators import delivery
from wattspark.operators.sliced import consecutive_pairs
from wattspark.plans.projections import readings, readings_with_factor
from wattspark.plans.registry import query


@query(
    "a31_sequence_gaps",
    "SELECT meter_id, min(seq) AS first_seq, max(seq) AS last_seq, count(DISTINCT seq) AS seen, "
    "max(seq) - min(seq) + 1 - count(DISTINCT seq) AS lost FROM readings GROUP BY meter_id",
)
def sequence_gaps(spark, sf_dir):
    return delivery.sequence_gaps(readings(spark, sf_dir))


@query(
    "a31_delivery_stats",
    "SELECT network_profile, count(*) AS received, CAST(sum(gap) AS BIGINT) AS lost, "
    "count(*) FILTER (seq < highest) AS reordered, sum(gap) / (count(*) + sum(gap)) AS loss_rate, "
    "count(*) / greatest((epoch_us(max(ingest_ts)) - epoch_us(min(ingest_ts))) / 1000000, 1) AS rate_per_second FROM ("
    "SELECT *, coalesce(greatest(seq - lag(seq) OVER (PARTITION BY meter_id ORDER BY event_ts, seq) - 1, 0), 0) AS gap, "
    "max(seq) OVER (PARTITION BY meter_id ORDER BY ingest_ts, event_ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
    "AS highest FROM readings) GROUP BY network_profile",
    "loss_rate rate_per_second",
)
def delivery_stats(spark, sf_dir):
    return delivery.delivery_stats(readings(spark, sf_dir))


@query(
    "w05_previous_reading",
    "SELECT * FROM (SELECT meter_id, event_ts, seq, "
    "lag(event_ts) OVER (PARTITION BY meter_id ORDER BY event_ts, seq) AS prev_event_ts, "
    "lag(seq) OVER (PARTITION BY meter_id ORDER BY event_ts, seq) AS prev_seq FROM readings) WHERE prev_event_ts IS NOT NULL",
)
def previous_reading(spark, sf_dir):
    return consecutive_pairs(readings(spark, sf_dir), ["meter_id"], ["event_ts", "seq"], [])


BAND = (
    "CASE network_profile WHEN 'wired' THEN ms NOT BETWEEN 1 AND 40 WHEN '5g' THEN ms NOT BETWEEN 1 AND 250 "
    "WHEN 'lte_m' THEN ms NOT BETWEEN 1 AND 400 WHEN 'satellite' THEN ms NOT BETWEEN 100 AND 1100 END"
)


@query(
    "a32_latency_by_profile",
    "SELECT network_profile, count(*) AS readings, avg(ms) AS avg_latency_ms, min(ms) AS min_latency_ms, "
    "max(ms) AS max_latency_ms, quantile_disc(ms, 0.95) AS p95_latency_ms, "
    f"count(*) FILTER ({BAND}) AS out_of_band FROM (SELECT network_profile, "
    "(epoch_us(ingest_ts) - epoch_us(event_ts)) / 1000 AS ms FROM readings) GROUP BY network_profile",
    "avg_latency_ms min_latency_ms max_latency_ms p95_latency_ms",
)
def latency_by_profile(spark, sf_dir):
    return delivery.latency_by_profile(readings(spark, sf_dir))


@query(
    "a33_meter_day_completeness",
    "SELECT meter_id, CAST(event_ts AS DATE) AS event_date, count(*) AS readings, CAST(96 AS BIGINT) AS expected_readings, "
    "count(*) / 96 AS completeness FROM readings GROUP BY ALL",
    "completeness",
)
def completeness(spark, sf_dir):
    return delivery.meter_day_completeness(readings(spark, sf_dir), "low_frequency")


@query(
    "a39_reading_gaps",
    "SELECT meter_id, pole_id, gap_start, gap_end, CAST(ceil(us / 900000000.0) - 1 AS BIGINT) AS missing_readings FROM ("
    "SELECT meter_id, pole_id, event_ts AS gap_end, lag(event_ts) OVER (PARTITION BY meter_id ORDER BY event_ts) AS gap_start, "
    "epoch_us(event_ts) - epoch_us(lag(event_ts) OVER (PARTITION BY meter_id ORDER BY event_ts)) AS us FROM readings) "
    "WHERE us > 1800000000",
)
def reading_gaps(spark, sf_dir):
    return delivery.reading_gaps(readings(spark, sf_dir), 900, 2.0)


@query(
    "p18_electrical_consistency",
    "SELECT meter_id, event_ts, power_kw * 1000 / (voltage_v * power_factor) AS implied_current_a, "
    "power_kw * tan(acos(power_factor)) AS implied_reactive_kvar, "
    "current_a - power_kw * 1000 / (voltage_v * power_factor) AS current_residual_a, "
    "reactive_kvar - power_kw * tan(acos(power_factor)) AS reactive_residual_kvar FROM readings",
    "implied_current_a implied_reactive_kvar current_residual_a reactive_residual_kvar",
)
def electrical_consistency(spark, sf_dir):
    rows = readings_with_factor(spark, sf_dir)
    return delivery.electrical_consistency(rows, F.col("power_factor")).select(
        "meter_id",
        "event_ts",
        "implied_current_a",
        "implied_reactive_kvar",
        "current_residual_a",
        "reactive_residual_kvar",
    )


CURVE = (
    "CASE WHEN h < 5 OR h >= 22 THEN 0.4 WHEN h < 6 THEN 0.4 + 2.1 * (h - 5) WHEN h < 9 THEN 2.5 "
    "WHEN h < 10 THEN 2.5 - 1.5 * (h - 9) WHEN h < 16 THEN 1.0 WHEN h < 17 THEN 1.0 + 3.0 * (h - 16) "
    "WHEN h < 21 THEN 4.0 ELSE 4.0 - 3.6 * (h - 21) END"
)


@query(
    "j05_load_against_curve",
    "SELECT meter_id, event_ts, CAST(kw AS DOUBLE) AS expected_kw, power_kw / kw AS load_factor FROM ("
    f"SELECT *, CAST({CURVE} AS DOUBLE) AS kw FROM (SELECT *, CAST(extract(hour FROM event_ts) AS DOUBLE) "
    "+ extract(minute FROM event_ts) / 60 + floor(extract(second FROM event_ts)) / 3600 AS h FROM readings))",
    "expected_kw load_factor",
)
def load_against_curve(spark, sf_dir):
    return delivery.load_against_curve(readings(spark, sf_dir)).select(
        "meter_id", "event_ts", "expected_kw", "load_factor"
    )
