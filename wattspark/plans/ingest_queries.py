"""Message parsing, validation and enrichment."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, functions as F

from wattspark.functions import columns as c
from wattspark.operators import ingest, strict
from wattspark.plans.projections import events, messages, readings
from wattspark.plans.registry import query

SEEN_AT = "2024-01-31 00:00:00"
WHOLE_BODY = (
    "'{\"event_ts\":\"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z\",\"meter_id\":\"' || meter_id || '\"'"
)


def _checked(spark, sf_dir):
    return ingest.validate(ingest.parse(messages(spark, sf_dir)), SEEN_AT)


@query(
    "p01_parse",
    "SELECT ts AS publish_ts, CASE WHEN class IN ('json_decode_error', 'parse_error') THEN class END AS parse_error, "
    f"CASE WHEN class = 'json_decode_error' THEN {WHOLE_BODY} END AS raw_data FROM messages",
)
def parse(spark, sf_dir):
    return _checked(spark, sf_dir).select("publish_ts", "parse_error", "raw_data")


@query(
    "p02_attributes",
    "SELECT ts AS publish_ts, meter_id, pole_id, network_profile FROM messages",
)
def attributes(spark, sf_dir):
    carried = ingest.parse(messages(spark, sf_dir))
    return carried.select(
        "publish_ts",
        *[
            F.try_element_at("attributes", F.lit(name)).alias(name)
            for name in ("meter_id", "pole_id", "network_profile")
        ],
    )


@query(
    "p03_status_split",
    "SELECT CASE WHEN class = 'ok' THEN 'success' ELSE 'error' END AS status, count(*) AS messages "
    "FROM messages GROUP BY ALL",
)
def status_split(spark, sf_dir):
    return _checked(spark, sf_dir).groupBy("status").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "p04_missing_fields",
    "SELECT ts AS publish_ts, 'Missing required field: pole_id,Missing required field: voltage_v' AS error_messages "
    "FROM messages WHERE k = 1",
)
def missing_fields(spark, sf_dir):
    rows = _checked(spark, sf_dir).filter(F.col("error_type") == ingest.VALIDATION_ERROR)
    return rows.select("publish_ts", "error_messages")


@query(
    "p05_bad_timestamps",
    "SELECT ts AS publish_ts, 'Invalid event_ts: not-a-time' AS error_message FROM messages WHERE k = 2",
)
def bad_timestamps(spark, sf_dir):
    rows = _checked(spark, sf_dir).filter(F.col("error_type") == ingest.TIMESTAMP_ERROR)
    return rows.select("publish_ts", "error_message")


@query(
    "p06_bad_numbers",
    "SELECT ts AS publish_ts, CASE k WHEN 3 THEN 'Invalid numeric value for voltage_v: abc' "
    "WHEN 4 THEN 'Invalid numeric value for power_kw: null' ELSE 'Invalid numeric value for seq: 12.7' END "
    "AS error_messages FROM messages WHERE k IN (3, 4, 6)",
)
def bad_numbers(spark, sf_dir):
    rows = _checked(spark, sf_dir).filter(F.col("error_type") == ingest.TYPE_ERROR)
    return rows.select("publish_ts", "error_messages")


@query(
    "p07_error_classes",
    "SELECT class AS error_type, count(*) AS messages FROM messages WHERE class <> 'ok' GROUP BY class",
)
def error_classes(spark, sf_dir):
    rows = ingest.errors(_checked(spark, sf_dir))
    return rows.groupBy("error_type").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "p08_error_records",
    "SELECT meter_id, class AS error_type, class IN ('validation_error', 'type_error') AS has_messages, "
    "class = 'json_decode_error' AS has_raw, class IN ('validation_error', 'timestamp_error', 'type_error') AS has_record, "
    "TIMESTAMP '2024-01-31' AS error_ts FROM messages WHERE class <> 'ok'",
)
def error_records(spark, sf_dir):
    return ingest.errors(_checked(spark, sf_dir)).select(
        F.col("attributes")["meter_id"].alias("meter_id"),
        "error_type",
        F.col("error_messages").isNotNull().alias("has_messages"),
        F.col("raw_data").isNotNull().alias("has_raw"),
        F.col("record").isNotNull().alias("has_record"),
        "error_ts",
    )


@query(
    "u01_combined_errors",
    "SELECT class AS error_type, meter_id FROM messages WHERE class <> 'ok'",
)
def combined_errors(spark, sf_dir):
    found = ingest.errors(_checked(spark, sf_dir))
    undecoded = F.col("error_type").isin(ingest.JSON_ERROR, ingest.PARSE_ERROR)
    branches = found.filter(undecoded).drop("record"), found.filter(~undecoded).drop("raw_data")
    return ingest.combine_errors(*branches).select(
        "error_type", F.col("attributes")["meter_id"].alias("meter_id")
    )


ENRICHED = (
    "SELECT ts AS event_ts, TIMESTAMP '2024-01-31' AS ingest_ts, meter_id, pole_id, event_id AS seq, voltage_v, "
    "current_a, power_kw, CAST(NULL AS DOUBLE) AS reactive_kvar, CAST(NULL AS DOUBLE) AS freq_hz, "
    "'' AS quality_flags, network_profile FROM messages WHERE class = 'ok'"
)
MEASURED = "voltage_v current_a power_kw"


@query("p10_enriched_readings", ENRICHED, MEASURED)
def enriched(spark, sf_dir):
    return ingest.enrich(ingest.successes(_checked(spark, sf_dir)), SEEN_AT)


@query(
    "p14_enriched_by_pole",
    "SELECT pole_id, network_profile, count(*) AS readings, sum(power_kw) AS total_power_kw "
    "FROM messages WHERE class = 'ok' GROUP BY ALL",
    "total_power_kw",
)
def enriched_by_pole(spark, sf_dir):
    valid, _ = ingest.parse_and_validate(messages(spark, sf_dir))
    return (
        ingest.enrich(valid)
        .groupBy("pole_id", "network_profile")
        .agg(F.count(F.lit(1)).alias("readings"), F.sum("power_kw").alias("total_power_kw"))
    )


@query(
    "p13_parse_and_validate",
    "SELECT ts AS publish_ts, meter_id, pole_id, network_profile, CAST(event_id AS VARCHAR) AS seq "
    "FROM messages WHERE class = 'ok'",
)
def parse_and_validate(spark, sf_dir):
    valid, _ = ingest.parse_and_validate(messages(spark, sf_dir))
    attribute = lambda name: F.try_element_at("attributes", F.lit(name)).alias(name)
    carried = [attribute(name) for name in ("meter_id", "pole_id", "network_profile")]
    return valid.select("publish_ts", *carried, F.col("fields")["seq"].alias("seq"))


@query(
    "p11_json_lines",
    "SELECT meter_id, event_id AS seq, voltage_v, true AS spells_nulls FROM messages WHERE class = 'ok'",
    "voltage_v",
)
def json_lines(spark, sf_dir):
    valid, _ = ingest.parse_and_validate(messages(spark, sf_dir))
    lines = ingest.json_lines(ingest.enrich(valid, SEEN_AT))
    row = F.from_json("value", "meter_id STRING, seq BIGINT, voltage_v DOUBLE")
    return lines.select(
        row.alias("r"), F.col("value").contains('"freq_hz":null').alias("spells_nulls")
    ).select("r.*", "spells_nulls")


PAYLOADS = (
    "SELECT class AS error_type, CASE k WHEN 5 THEN '' WHEN 2 THEN 'not-a-time' "
    "ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END AS event_ts, CASE k WHEN 5 THEN '' ELSE meter_id END AS meter_id, "
    "CASE WHEN k IN (0, 5) THEN '' WHEN k = 6 THEN '12.7' ELSE CAST(event_id AS VARCHAR) END AS seq "
    "FROM messages WHERE class <> 'ok'"
)


def shown_payloads(payloads: DataFrame) -> DataFrame:
    """The class of each dead letter, and members of the message it carries, well formed or not."""
    text = F.decode("value", "UTF-8")
    body = F.decode(F.unbase64(F.get_json_object(text, "$.body")), "UTF-8")
    member = lambda name, value: F.regexp_extract(body, f'"{name}":"?({value})', 1).alias(name)
    return payloads.select(
        F.get_json_object(text, "$.error_type").alias("error_type"),
        member("event_ts", '[^"]+'),
        member("meter_id", '[^"]+'),
        member("seq", "[0-9.]+"),
    )


@query("p12_error_payloads", PAYLOADS)
def error_payloads(spark, sf_dir):
    return shown_payloads(ingest.error_bytes(ingest.parse_and_validate(messages(spark, sf_dir))[1]))


STRICT = (
    "(SELECT meter_id, event_ts, list_filter(["
    "CASE WHEN voltage_v NOT BETWEEN 0 AND 500 THEN 'voltage_v_range' END, "
    "CASE WHEN current_a NOT BETWEEN 0 AND 200 THEN 'current_a_range' END, "
    "CASE WHEN power_kw NOT BETWEEN 0 AND 50 THEN 'power_kw_range' END, "
    "CASE WHEN freq_hz NOT BETWEEN 45 AND 65 THEN 'freq_hz_range' END], lambda x: x IS NOT NULL) AS violations FROM "
    "(SELECT meter_id, event_ts, voltage_v * 2.2 AS voltage_v, current_a * 12 AS current_a, "
    "power_kw * 20 AS power_kw, freq_hz FROM readings))"
)


def _stretched(spark, sf_dir):
    """Measurements scaled so that some leave the ranges of the schema."""
    return readings(spark, sf_dir).withColumns(
        {
            "voltage_v": F.col("voltage_v") * 2.2,
            "current_a": F.col("current_a") * 12,
            "power_kw": F.col("power_kw") * 20,
        }
    )


@query(
    "p15_schema_violations",
    f"SELECT meter_id, event_ts, array_to_string(violations, ',') AS violations FROM {STRICT}",
)
def schema_violations(spark, sf_dir):
    return strict.violations(_stretched(spark, sf_dir)).select("meter_id", "event_ts", "violations")


@query(
    "p15_violation_counts",
    f"SELECT rule, count(*) AS readings FROM (SELECT unnest(violations) AS rule FROM {STRICT}) GROUP BY rule",
)
def violation_counts(spark, sf_dir):
    return strict.violation_counts(_stretched(spark, sf_dir))


@query(
    "p15_unknown_properties",
    "SELECT ts AS publish_ts, '' AS unknown_properties FROM messages WHERE class = 'ok'",
)
def unknown_properties(spark, sf_dir):
    valid, _ = ingest.parse_and_validate(messages(spark, sf_dir))
    return strict.unknown_properties(valid).select("publish_ts", "unknown_properties")


@query(
    "f23_readable_prefix",
    "SELECT ts AS publish_ts, meter_id, substring(concat(meter_id, chr(65533), chr(228), chr(65533), "
    "repeat(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), event_id % 60)), 1, 1000) AS shown FROM messages",
)
def readable_prefix(spark, sf_dir):
    """Bodies with a byte that no character has and a character cut short; most are longer than is shown."""
    sent = events(spark, sf_dir).select(
        "event_id",
        F.col("ts").alias("publish_ts"),
        F.concat(F.lit("m_"), F.col("user_id").cast("string")).alias("meter_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso"),
    )
    times = F.expr("CAST(event_id % 60 AS INT)")
    body = F.concat(
        F.encode("meter_id", "UTF-8"), F.unhex(F.lit("FFC3A4E282")), F.encode(F.repeat("iso", times), "UTF-8")
    )
    return sent.select("publish_ts", "meter_id", c.readable_prefix(body).alias("shown"))


@query(
    "f21_stamped_now",
    "SELECT meter_id, count(*) AS readings, CAST(1 AS BIGINT) AS stamps, true AS in_time FROM messages "
    "WHERE class = 'ok' GROUP BY meter_id",
)
def stamped_now(spark, sf_dir):
    """Readings enriched without a given time carry that of the query: one for all, and not before its start."""
    begun = datetime.now(timezone.utc)
    found = ingest.enrich(ingest.successes(ingest.validate(ingest.parse(messages(spark, sf_dir)))))
    now = F.col("ingest_ts")
    late = F.lit(begun + timedelta(days=1)).cast("timestamp")
    return found.groupBy("meter_id").agg(
        F.count(F.lit(1)).alias("readings"),
        (F.count_distinct(now) + F.count_if(now.isNull())).alias("stamps"),
        F.min((now >= F.lit(begun).cast("timestamp")) & (now < late)).alias("in_time"),
    )
