"""Meter, message and device tables derived from the ``events`` table.

Each is a row-wise projection of all events: no window, no shuffle, nothing
filtered out. The SQL beside it states the same table for the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspark.functions.columns import line_current, reactive_power
from wattspark.functions.quality import voltage_flags
from wattspark.operators.der import CURVE_RATING_KW, WIND_CURVE, union_fleet
from wattspark.session import configure

EVENTS = (
    "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
# Start of the data and the sampling slot that numbers readings.
EPOCH = 1_704_067_200
SLOT_SECONDS = 900
NAMEPLATE_KW = 50.0
NOMINAL_PV_KW = 25.0


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def _delay_ms() -> Column:
    """Arrival delay: sub-second, for some a minute, for a few half a day."""
    event = F.col("event_id")
    return (
        event % 1200
        + F.when(event % 9 == 0, 60_000).otherwise(0)
        + F.when(event % 40 == 0, 43_200_000).otherwise(0)
    )


def factor() -> Column:
    return F.lit(0.85) + (F.col("_user") % 15) / F.lit(100.0)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as meter readings; ``seq`` is the 15-minute sampling slot."""
    return readings_with_factor(spark, sf_dir).drop("power_factor")


def numbered_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings whose ``seq`` is their own: the number of the event."""
    rows = _all_columns(spark, sf_dir).drop("seq", "power_factor")
    return rows.withColumnRenamed("event_id", "seq")


def readings_with_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_columns(spark, sf_dir).drop("event_id")


def _all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    volts = F.lit(190.0) + F.col("value") % F.lit(80.0)
    kw = F.col("value") / F.lit(100.0)
    profile = (
        F.when(F.col("event_type") == "click", "wired")
        .when(F.col("event_type") == "view", "5g")
        .when(F.col("event_type") == "signup", "lte_m")
        .when(F.col("event_type") == "error", "satellite")
    )
    base = events(spark, sf_dir).withColumn("_user", F.col("user_id"))
    return base.select(
        F.col("ts").alias("event_ts"),
        F.timestamp_micros(F.unix_micros("ts") + _delay_ms() * 1000).alias("ingest_ts"),
        F.concat(F.lit("m_"), F.col("user_id").cast("string")).alias("meter_id"),
        F.concat(F.lit("pole_"), (F.col("user_id") % 10).cast("string")).alias("pole_id"),
        F.floor((F.unix_seconds("ts") - EPOCH) / SLOT_SECONDS).cast("long").alias("seq"),
        volts.alias("voltage_v"),
        F.round(line_current(kw, volts, factor()), 6).alias("current_a"),
        kw.alias("power_kw"),
        F.when(F.col("event_id") % 13 != 0, F.round(reactive_power(kw, factor()), 6)).alias(
            "reactive_kvar"
        ),
        F.round(F.lit(60.0) + (F.col("event_id") % 11 - 5) * F.lit(0.01), 3).alias("freq_hz"),
        voltage_flags(volts).alias("quality_flags"),
        profile.alias("network_profile"),
        factor().alias("power_factor"),
        "event_id",
    )


READINGS_SQL = """
readings AS (
  SELECT event_id, ts AS event_ts,
    make_timestamp(epoch_us(ts) + 1000 * (event_id % 1200
      + CASE WHEN event_id % 9 = 0 THEN 60000 ELSE 0 END
      + CASE WHEN event_id % 40 = 0 THEN 43200000 ELSE 0 END)) AS ingest_ts,
    'm_' || CAST(user_id AS VARCHAR) AS meter_id,
    'pole_' || CAST(user_id % 10 AS VARCHAR) AS pole_id,
    CAST(floor((epoch_us(ts) - 1704067200000000) / 900000000.0) AS BIGINT) AS seq,
    CAST(190 AS DOUBLE) + value % CAST(80 AS DOUBLE) AS voltage_v,
    CASE WHEN value > 0 THEN round(value / CAST(100 AS DOUBLE) * 1000
      / ((CAST(190 AS DOUBLE) + value % CAST(80 AS DOUBLE))
         * (CAST(0.85 AS DOUBLE) + (user_id % 15) / CAST(100 AS DOUBLE))), 6) ELSE 0.0 END AS current_a,
    value / CAST(100 AS DOUBLE) AS power_kw,
    CASE WHEN event_id % 13 <> 0 THEN round(value / CAST(100 AS DOUBLE)
      * tan(acos(CAST(0.85 AS DOUBLE) + (user_id % 15) / CAST(100 AS DOUBLE))), 6) END AS reactive_kvar,
    round(CAST(60 AS DOUBLE) + (event_id % 11 - 5) * CAST(0.01 AS DOUBLE), 3) AS freq_hz,
    CASE WHEN CAST(190 AS DOUBLE) + value % CAST(80 AS DOUBLE) < 220 THEN ['voltage_sag']
         WHEN CAST(190 AS DOUBLE) + value % CAST(80 AS DOUBLE) > 260 THEN ['voltage_swell']
         ELSE CAST([] AS VARCHAR[]) END AS quality_flags,
    CASE event_type WHEN 'click' THEN 'wired' WHEN 'view' THEN '5g'
      WHEN 'signup' THEN 'lte_m' WHEN 'error' THEN 'satellite' END AS network_profile,
    CAST(0.85 AS DOUBLE) + (user_id % 15) / CAST(100 AS DOUBLE) AS power_factor
  FROM events)
"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as broker messages; seven in fifty are broken in a known way."""
    ev = events(spark, sf_dir).withColumn("_k", F.col("event_id") % 50)
    k = F.col("_k")
    event_ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    meter = F.concat(F.lit("m_"), F.col("user_id").cast("string"))
    pole = F.concat(F.lit("pole_"), (F.col("user_id") % 10).cast("string"))
    volts = F.format_string("%.2f", F.lit(190.0) + F.col("value") % 80)
    members = [
        F.concat(F.lit('"event_ts":'), F.when(k == 2, '"not-a-time"').otherwise(quoted(event_ts))),
        F.concat(F.lit('"meter_id":'), quoted(meter)),
        F.when(k != 1, F.concat(F.lit('"pole_id":'), quoted(pole))),
        F.concat(
            F.lit('"seq":'), F.when(k == 6, '"12.7"').otherwise(F.col("event_id").cast("string"))
        ),
        F.when(k != 1, F.concat(F.lit('"voltage_v":'), F.when(k == 3, '"abc"').otherwise(volts))),
        F.concat(F.lit('"current_a":'), F.format_string("%.4f", F.col("value") / 20)),
        F.concat(
            F.lit('"power_kw":'),
            F.when(k == 4, "null").otherwise(F.format_string("%.4f", F.col("value") / 100)),
        ),
    ]
    whole = F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*members)), ","), F.lit("}"))
    cut = F.concat(F.lit("{"), members[0], F.lit(","), members[1])
    body = F.when(k == 0, cut).when(k == 5, "[1,2]").otherwise(whole)
    profile = (
        F.when(F.col("event_type") == "click", "wired")
        .when(F.col("event_type") == "view", "5g")
        .when(F.col("event_type") == "signup", "lte_m")
        .when(F.col("event_type") == "error", "satellite")
    )
    attributes = F.map_filter(
        F.create_map(
            F.lit("meter_id"), meter, F.lit("pole_id"), pole, F.lit("network_profile"), profile
        ),
        lambda _, v: v.isNotNull(),
    )
    return ev.select(
        F.encode(body, "UTF-8").alias("data"),
        attributes.alias("attributes"),
        F.col("ts").alias("publish_ts"),
    )


MESSAGES_SQL = """
messages AS (
  SELECT *, event_id % 50 AS k,
    CASE event_id % 50 WHEN 0 THEN 'json_decode_error' WHEN 1 THEN 'validation_error'
      WHEN 2 THEN 'timestamp_error' WHEN 3 THEN 'type_error' WHEN 4 THEN 'type_error'
      WHEN 5 THEN 'parse_error' WHEN 6 THEN 'type_error' ELSE 'ok' END AS class,
    'm_' || CAST(user_id AS VARCHAR) AS meter_id,
    'pole_' || CAST(user_id % 10 AS VARCHAR) AS pole_id,
    CASE event_type WHEN 'click' THEN 'wired' WHEN 'view' THEN '5g'
      WHEN 'signup' THEN 'lte_m' WHEN 'error' THEN 'satellite' END AS network_profile,
    round(CAST(190 AS DOUBLE) + value % CAST(80 AS DOUBLE), 2) AS voltage_v,
    round(value / 20, 4) AS current_a, round(value / 100, 4) AS power_kw
  FROM events)
"""


def _device(kind: str) -> list[Column]:
    return [
        F.concat(F.lit(f"DER-{kind}-"), F.col("user_id").cast("string")).alias("device_id"),
        F.lit(kind).alias("device_type"),
        F.date_trunc("minute", "ts").alias("ts"),
        F.col("event_id").alias("seq"),
    ]


def batteries(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, event = F.col("value"), F.col("event_id")
    return events(spark, sf_dir).filter(F.col("user_id") % 3 == 0).select(
        *_device("battery"),
        F.round(value % 100, 1).alias("capacity"),
        F.round(value, 1).alias("power_output"),
        (3 + (event % 20) / 10).alias("run_time"),
        (1500 + event % 500).alias("cycle_life"),
        (event % 4 != 0).alias("dischargable"),
    )


def photovoltaics(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = F.round(F.col("value") / 4, 1)
    return events(spark, sf_dir).filter(F.col("user_id") % 3 == 1).select(
        *_device("PV"),
        F.lit(NOMINAL_PV_KW).alias("nominal_power"),
        output.alias("power_output"),
        (output / NOMINAL_PV_KW * 100).cast("long").alias("performance_ratio"),
    )


def wind_machines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Output follows the curve, except that every seventh event falls to 60 %."""
    speed = 5 + F.col("event_id") % 20
    on_curve = F.array(*[F.lit(kw) for kw in WIND_CURVE])[(speed - 1).cast("int")]
    output = F.round(on_curve * NAMEPLATE_KW / CURVE_RATING_KW, 1)
    return events(spark, sf_dir).filter(F.col("user_id") % 3 == 2).select(
        *_device("wind"),
        F.lit(NAMEPLATE_KW).alias("nameplate_capacity"),
        speed.cast("double").alias("wind_speed"),
        F.when(F.col("event_id") % 7 == 0, F.round(output * 0.6, 1))
        .otherwise(output)
        .alias("power_output"),
    )


def fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as telemetry of three kinds of resource, in one wide table."""
    return union_fleet(
        batteries(spark, sf_dir), photovoltaics(spark, sf_dir), wind_machines(spark, sf_dir)
    )


CURVE_SQL = (
    "curve AS (SELECT CAST(s AS BIGINT) AS speed, CAST(kw AS DOUBLE) AS kw FROM (VALUES "
    + ", ".join(f"({speed}, {kw})" for speed, kw in enumerate(WIND_CURVE, start=1))
    + ") AS t(s, kw))"
)

FLEET_SQL = (
    CURVE_SQL
    + """,
fleet AS (
  SELECT 'DER-' || t.kind || '-' || CAST(user_id AS VARCHAR) AS device_id, t.kind AS device_type,
    date_trunc('minute', ts) AS ts, event_id AS seq,
    CASE WHEN kind = 'battery' THEN round(value % CAST(100 AS DOUBLE), 1) END AS capacity,
    CASE kind WHEN 'battery' THEN round(value, 1) WHEN 'PV' THEN round(value / 4, 1)
      ELSE CASE WHEN event_id % 7 = 0
        THEN round(round(c.kw * CAST(50 AS DOUBLE) / 95, 1) * CAST(0.6 AS DOUBLE), 1)
        ELSE round(c.kw * CAST(50 AS DOUBLE) / 95, 1) END END AS power_output,
    CASE WHEN kind = 'battery' THEN 3 + (event_id % 20) / CAST(10 AS DOUBLE) END AS run_time,
    CASE WHEN kind = 'battery' THEN 1500 + event_id % 500 END AS cycle_life,
    CASE WHEN kind = 'battery' THEN event_id % 4 <> 0 END AS dischargable,
    CASE WHEN kind = 'PV' THEN CAST(25 AS DOUBLE) END AS nominal_power,
    CASE WHEN kind = 'PV' THEN CAST(trunc(round(value / 4, 1) / CAST(25 AS DOUBLE) * 100) AS BIGINT) END
      AS performance_ratio,
    CASE WHEN kind = 'wind' THEN CAST(50 AS DOUBLE) END AS nameplate_capacity,
    CASE WHEN kind = 'wind' THEN CAST(5 + event_id % 20 AS DOUBLE) END AS wind_speed
  FROM events JOIN (VALUES (0, 'battery'), (1, 'PV'), (2, 'wind')) AS t(r, kind) ON user_id % 3 = t.r
  JOIN curve c ON c.speed = 5 + event_id % 20)
"""
)
