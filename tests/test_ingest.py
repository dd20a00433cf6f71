import json

import pytest
from pyspark.sql import functions as F

from tests.build import rows
from wattspark.operators import ingest, strict
from wattspark.schemas import ENVELOPE

GOOD = {
    "event_ts": "2025-12-26T12:00:00Z",
    "meter_id": "test_001",
    "pole_id": "pole_A",
    "voltage_v": 240.0,
    "current_a": 5.0,
    "power_kw": 1.2,
}


def checked(spark, *bodies, attributes=None):
    data = [
        (b if isinstance(b, bytes) else json.dumps(b, ensure_ascii=False).encode(), attributes or {"pole_id": "pole_A"}, None)
        for b in bodies
    ]
    df = spark.createDataFrame([(bytearray(d), a, t) for d, a, t in data], ENVELOPE)
    return ingest.validate(ingest.parse(df), "2025-12-26 12:00:05")


def without(*fields, **changes):
    return {k: v for k, v in {**GOOD, **changes}.items() if k not in fields}


def test_valid_message_becomes_a_typed_reading(spark):
    row = ingest.enrich(ingest.successes(checked(spark, {**GOOD, "seq": 100}))).first()
    assert row.meter_id == "test_001" and row.seq == 100 and row.voltage_v == 240.0
    assert row.network_profile is None and row.quality_flags == [] and row.freq_hz is None
    assert row.ingest_ts is not None


def test_event_time_is_utc(spark):
    df = ingest.enrich(ingest.successes(checked(spark, without(event_ts="2025-12-26T14:00:00+02:00"), GOOD)))
    assert {r[0] for r in df.select(F.unix_seconds("event_ts")).collect()} == {1766750400}


def test_profile_comes_from_attributes_only(spark):
    df = checked(spark, without(network_profile="5g"), attributes={"network_profile": "lte_m"})
    assert ingest.enrich(ingest.successes(df)).first().network_profile == "lte_m"


@pytest.mark.parametrize(
    "body, kind",
    [
        (b"not valid json", "json_decode_error"),
        (b"", "json_decode_error"),
        (b'{"a": 1} trailing', "json_decode_error"),
        (b'{"a": 1},{"b": 2}', "json_decode_error"),
        (b"[1, 2]", "parse_error"),
        (b"12", "parse_error"),
        (b"null", "parse_error"),
        (b'{"a": "\xff"}', "parse_error"),
        (without("pole_id"), "validation_error"),
        ({}, "validation_error"),
        (without(event_ts="not-a-time"), "timestamp_error"),
        (without(event_ts="2025"), "timestamp_error"),
        (without(event_ts="2025-13-40T00:00:00Z"), "timestamp_error"),
        (without(voltage_v="abc"), "type_error"),
        (without(voltage_v="240.0d"), "type_error"),
        (without(voltage_v=[1]), "type_error"),
        (without(power_kw=None), "type_error"),
        (without(meter_id=None), "type_error"),
        (without(seq="12.7"), "type_error"),
        (without(seq="true"), "type_error"),
        (GOOD, None),
        (without(voltage_v="240.5"), None),
        (without(voltage_v=" 1e2 "), None),
        (without(voltage_v=True), None),
        (without(seq=12.7), None),
        (without(seq=None), None),
        (without(event_ts=1766750400), None),
        (without(event_ts="2025-12-26"), None),
        (without(meter_id=7), None),
        (without(quality_flags=["estimated"]), None),
    ],
)
def test_classes(spark, body, kind):
    row = checked(spark, body).first()
    assert row.error_type == kind
    assert row.status == ("success" if kind is None else "error")


def test_missing_fields_are_listed_in_order(spark):
    row = checked(spark, {"event_ts": GOOD["event_ts"], "meter_id": "m"}).first()
    assert row.error_messages == [
        f"Missing required field: {f}" for f in ("pole_id", "voltage_v", "current_a", "power_kw")
    ]
    assert json.loads(row.record)["meter_id"] == "m" and row.raw_data is None


def test_first_class_wins(spark):
    bodies = [without("pole_id", event_ts="x", power_kw="y"), without(event_ts="x", power_kw="y")]
    assert [r.error_type for r in checked(spark, *bodies).collect()] == [
        "validation_error",
        "timestamp_error",
    ]


def test_raw_text_is_kept_to_a_thousand_characters(spark):
    row = checked(spark, b"x" * 5000).first()
    assert row.raw_data == "x" * 1000 and row.record is None


def test_values_after_coercion(spark):
    bodies = [
        without(seq=12.7, voltage_v=True),
        without(seq="41", voltage_v=" 1e2 ", quality_flags=["estimated", "missing"]),
    ]
    got = ingest.enrich(ingest.successes(checked(spark, *bodies)))
    assert [(r.seq, r.voltage_v, r.quality_flags) for r in got.collect()] == [
        (12, 1.0, []),
        (41, 100.0, ["estimated", "missing"]),
    ]


def test_every_message_is_either_valid_or_an_error(spark):
    all_rows = checked(spark, GOOD, b"{", without("pole_id"), without(seq="x"))
    assert ingest.successes(all_rows).count() + ingest.errors(all_rows).count() == 4


@pytest.mark.parametrize(
    "text, want",
    [
        ("20251226T120000Z", "2025-12-26 12:00:00"),
        ("2025-12-26T12", "2025-12-26 12:00:00"),
        ("2025-12-26T12:00:00.123456789Z", "2025-12-26 12:00:00.123456"),
        ("2025-12-26 12:00:00+0100", "2025-12-26 11:00:00"),
        ("2025-12-26", "2025-12-26 00:00:00"),
        ("26.12.2025", None),
    ],
)
def test_iso_forms_are_read(spark, text, want):
    df = spark.createDataFrame([(text,)], "t STRING").select(ingest._iso_time(F.col("t")).cast("string"))
    assert df.first()[0] == want


def test_the_last_of_repeated_members_counts_and_wide_numbers_are_errors(spark):
    head = b'{"event_ts": "2025-12-26T12:00:00Z", "meter_id": "m", "pole_id": "p", "current_a": 1.0, "power_kw": 1.0, '
    bodies = [
        head + b'"seq": 1, "voltage_v": 240.0, "voltage_v": 210.0}',
        head + b'"seq": 99999999999999999999, "voltage_v": 240.0}',
        b"[1,2]",
    ]
    df = spark.createDataFrame([(bytearray(b), {}, None) for b in bodies], ENVELOPE)
    valid, bad = ingest.parse_and_validate(df)
    assert [r.voltage_v for r in ingest.enrich(valid).collect()] == [210.0]
    found = {r.error_type: bytes(r.body) for r in bad.collect()}
    assert found == {"type_error": bodies[1], "parse_error": bodies[2]}


def test_error_bytes_are_utf8_json(spark):
    found = ingest.errors(checked(spark, without("pole_id", meter_id="Zähler")))
    body = json.loads(bytes(ingest.error_bytes(found).first().value).decode("utf-8"))
    assert body["error_type"] == "validation_error" and "Zähler" in body["record"]


def test_unknown_properties(spark):
    valid = ingest.successes(checked(spark, without(firmware="1.2", brand="x")))
    assert strict.unknown_properties(valid).first().unknown_properties == ["brand", "firmware"]


def test_filters_do_not_repeat_the_parse(spark):
    df = ingest.enrich(ingest.successes(checked(spark, GOOD))).filter("voltage_v > 200")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(ArrayType(MapType") == 1


def test_strict_rules(spark):
    from tests.build import reading, readings

    df = readings(
        spark,
        reading(volts=600.0, meter="bad id", seq=-1),
        reading(freq_hz=70.0, quality_flags=["odd"], network_profile="fax"),
        reading(),
    )
    assert rows(strict.violation_counts(df)) == [
        ("freq_hz_range", 1),
        ("meter_id_pattern", 1),
        ("network_profile_enum", 1),
        ("quality_flags_enum", 1),
        ("seq_negative", 1),
        ("voltage_v_range", 1),
    ]
