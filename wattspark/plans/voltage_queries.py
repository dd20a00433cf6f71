"""Voltage events and window queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattspark.functions.quality import low_voltage_flag
from wattspark.operators import voltage
from wattspark.plans.projections import readings
from wattspark.plans.registry import query

AS_OF = "2024-01-31"
EVENT_COLUMNS = (
    "meter_id", "pole_id", "event_start", "event_end", "duration_seconds", "min_voltage_v",
    "max_voltage_v", "avg_voltage_v", "reading_count", "severity",
)
VOLTS = "min_voltage_v max_voltage_v avg_voltage_v"


def events_sql(hit: str, least: int, severity: str | None = None, source: str = "readings", max_gap: int | None = None) -> str:
    """Runs found by counting the readings outside the condition that came before; with ``max_gap`` seconds,
    also those that came too long after the reading before them."""
    if max_gap is not None:
        source = f"(SELECT *, lag(event_ts) OVER (PARTITION BY meter_id ORDER BY event_ts, seq) AS before FROM {source})"
    near = "" if max_gap is None else f" AND coalesce(event_ts - before <= INTERVAL {max_gap} SECOND, true)"
    severity = severity or (
        "CASE WHEN min_voltage_v < 200 THEN 'CRITICAL' WHEN min_voltage_v < 210 THEN 'WARNING' "
        "ELSE 'MINOR' END"
    )
    return f"""
  SELECT meter_id, pole_id, event_start, event_end,
    date_sub('second', event_start, event_end) + 1 AS duration_seconds,
    min_voltage_v, max_voltage_v, avg_voltage_v, reading_count, {severity} AS severity
  FROM (SELECT meter_id, pole_id, min(event_ts) AS event_start, max(event_ts) AS event_end,
      min(voltage_v) AS min_voltage_v, max(voltage_v) AS max_voltage_v,
      avg(voltage_v) AS avg_voltage_v, count(*) AS reading_count
    FROM (SELECT *, sum(CASE WHEN {hit}{near} THEN 0 ELSE 1 END) OVER (PARTITION BY meter_id
        ORDER BY event_ts, seq ROWS UNBOUNDED PRECEDING) AS breaks FROM {source}) AS marked
    WHERE {hit} GROUP BY meter_id, pole_id, breaks) AS runs
  WHERE date_sub('second', event_start, event_end) + 1 >= {least}"""


@query("a05_sag_events", events_sql("voltage_v < 220", 5), VOLTS)
def sag_events(spark, sf_dir) -> DataFrame:
    return voltage.sag_events(readings(spark, sf_dir)).select(*EVENT_COLUMNS)


MAX_GAP = 43_200  # seconds; meters of the projection report some times a day


@query("a05_sag_events_split_by_gaps", events_sql("voltage_v < 220", 5, max_gap=MAX_GAP), VOLTS)
def sag_events_split_by_gaps(spark, sf_dir) -> DataFrame:
    return voltage.sag_events(readings(spark, sf_dir), max_gap_seconds=MAX_GAP).select(*EVENT_COLUMNS)


@query(
    "a05_recent_sag_report",
    events_sql("voltage_v < 220", 5, source="(SELECT * FROM readings WHERE event_ts >= DATE '2024-01-30')")
    + " ORDER BY event_start DESC, meter_id",
    VOLTS,
)
def recent_sags(spark, sf_dir):
    return voltage.recent_sag_events(readings(spark, sf_dir), AS_OF).select(*EVENT_COLUMNS)


@query(
    "a06_anomalies",
    "SELECT meter_id, pole_id, event_start, event_end, duration_seconds, "
    "CAST(round(CAST(min_voltage_v AS DECIMAL(28, 9)), 2) AS DOUBLE) AS min_voltage_v, CAST(round(CAST(avg_voltage_v AS DECIMAL(28, 9)), 2) AS DOUBLE) AS avg_voltage_v, severity FROM ("
    + events_sql(
        "voltage_v < 220",
        60,
        source="(SELECT * FROM readings WHERE event_ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25 12:00:00')",
    )
    + ") ORDER BY event_start DESC, meter_id, pole_id LIMIT 100",
)
def anomalies(spark, sf_dir):
    return voltage.anomalies(
        readings(spark, sf_dir), "2024-01-05 00:00:00", "2024-01-25 12:00:00", 60, 100
    )


@query("a07_swell_events", events_sql("voltage_v > 260", 1, "'MINOR'"), VOLTS)
def swell_events(spark, sf_dir):
    return voltage.swell_events(readings(spark, sf_dir), min_duration_seconds=1).select(
        *EVENT_COLUMNS
    )


@query("a08_critical_sag_events", events_sql("voltage_v < 200", 3), VOLTS)
def critical_sags(spark, sf_dir):
    return voltage.critical_sag_events(readings(spark, sf_dir)).select(*EVENT_COLUMNS)


@query("a05_all_low_runs", events_sql("voltage_v < 220", 1), VOLTS)
def low_runs(spark, sf_dir):
    return voltage.sag_events(readings(spark, sf_dir), min_duration_seconds=1).select(
        *EVENT_COLUMNS
    )


@query(
    "k10_voltage_event_rows",
    "SELECT sha256(concat_ws('|', meter_id, pole_id, strftime(event_start, '%Y-%m-%d %H:%M:%S.%f'), 'sag')) AS event_id, "
    "meter_id, pole_id, 'sag' AS event_type, lower(severity) AS severity, event_start, event_end, "
    "duration_seconds, min_voltage_v, max_voltage_v, avg_voltage_v, reading_count, "
    "TIMESTAMP '2024-01-31 00:00:00' AS detected_at FROM ("
    + events_sql("voltage_v < 220", 5)
    + ")",
    VOLTS,
)
def voltage_event_rows(spark, sf_dir):
    return voltage.event_rows(
        voltage.sag_events(readings(spark, sf_dir)), "sag", "2024-01-31 00:00:00"
    )


@query(
    "p16_low_voltage_flag",
    "SELECT meter_id, event_ts, voltage_v, CAST(voltage_v < 220 AS BIGINT) AS is_low_voltage FROM readings",
    "voltage_v",
)
def flags(spark, sf_dir):
    return readings(spark, sf_dir).select(
        "meter_id", "event_ts", "voltage_v", low_voltage_flag(F.col("voltage_v")).alias("is_low_voltage")
    )


NUMBERED = """(SELECT meter_id, event_ts, seq, CAST(voltage_v < 220 AS BIGINT) AS is_low_voltage,
    row_number() OVER (PARTITION BY meter_id ORDER BY event_ts, seq) AS rn,
    row_number() OVER (PARTITION BY meter_id, voltage_v < 220 ORDER BY event_ts, seq) AS rn_group
  FROM readings) AS numbered"""


@query("w01_row_number_per_meter", f"SELECT meter_id, event_ts, rn FROM {NUMBERED}")
def row_number_per_meter(spark, sf_dir):
    return voltage.number_readings(readings(spark, sf_dir)).select("meter_id", "event_ts", "rn")


@query(
    "w02_row_number_per_class",
    f"SELECT meter_id, event_ts, is_low_voltage, rn_group FROM {NUMBERED}",
)
def row_number_per_class(spark, sf_dir):
    return voltage.number_readings(readings(spark, sf_dir)).select(
        "meter_id", "event_ts", "is_low_voltage", "rn_group"
    )


@query(
    "w03_island_ids",
    f"SELECT meter_id, event_ts, is_low_voltage, rn - rn_group AS island_id FROM {NUMBERED}",
)
def island_ids(spark, sf_dir):
    return voltage.number_readings(readings(spark, sf_dir)).select(
        "meter_id", "event_ts", "is_low_voltage", "island_id"
    )


ROLLING = """(SELECT meter_id, pole_id, event_ts, voltage_v,
    CAST(sum(CASE WHEN voltage_v < 220 THEN 1 ELSE 0 END) OVER (PARTITION BY meter_id ORDER BY event_ts
      RANGE BETWEEN INTERVAL 6 HOURS PRECEDING AND CURRENT ROW) AS BIGINT) AS low_voltage_count
  FROM readings) AS rolled"""


@query("w04_rolling_low_count", f"SELECT meter_id, event_ts, low_voltage_count FROM {ROLLING}")
def rolling_count(spark, sf_dir):
    return voltage.rolling_low_voltage(readings(spark, sf_dir), 6 * 3600).select(
        "meter_id", "event_ts", "low_voltage_count"
    )


@query(
    "a26_rolling_alerts",
    "SELECT DISTINCT meter_id, pole_id, event_ts AS alert_time, voltage_v AS current_voltage "
    f"FROM {ROLLING} WHERE low_voltage_count >= 2 ORDER BY alert_time DESC, meter_id",
    "current_voltage",
)
def rolling_alerts(spark, sf_dir):
    return voltage.rolling_alerts(readings(spark, sf_dir), 6 * 3600, 2)
