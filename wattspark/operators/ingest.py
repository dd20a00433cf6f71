"""Parse, validate and enrich device messages, routing bad ones to a dead letter.

All steps are row-wise column expressions: batch and streaming DataFrames run
the same code, in one stage and without a Python function.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from wattspark.functions.columns import instant
from wattspark.schemas import NUMERIC_FIELDS, READINGS, REQUIRED_FIELDS

# Error classes and texts.
JSON_ERROR = "json_decode_error"
PARSE_ERROR = "parse_error"
VALIDATION_ERROR = "validation_error"
TIMESTAMP_ERROR = "timestamp_error"
TYPE_ERROR = "type_error"
MISSING_FIELD = "Missing required field: "
BAD_NUMBER = "Invalid numeric value for "
BAD_TIME = "Invalid event_ts: "
RAW_KEPT = 1000

# Extended and basic ISO forms: hours alone, any number of fraction digits, offsets with or without
# a colon. Basic forms and longer fractions are rewritten to the extended form before they are read.
ISO_TIME = (
    r"^\d{4}(-\d{2}-\d{2}|\d{4})([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)
# The usual form, read without rewriting.
PLAIN_TIME = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:\d{2})?)?$"
)
NUMBER_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"
INTEGER_TEXT = r"^\s*[+-]?\d+\s*$"
BOOLEANS = ("true", "false")

ERROR_COLUMNS = (
    "error_type", "error_message", "error_messages", "raw_data", "record", "body", "error_ts",
)


def _text(name: str) -> Column:
    """Text of a member: NULL where it is absent or a JSON null."""
    return F.col("fields")[name]


def _names(names: tuple[str, ...]) -> Column:
    return F.array(*[F.lit(name) for name in names])


def _json_type(name: str | Column) -> Column:
    """JSON type of a member. Parses the body again, so only for texts that leave it open."""
    members = F.try_variant_get(F.try_parse_json("raw"), "$", "map<string,variant>")
    return F.schema_of_variant(members[name])


# The checks below are CASE expressions: their branches, unlike the sides of AND and OR,
# are left alone by common-subexpression elimination, so the rare ones stay rare.


def _is_number(name: Column) -> Column:
    """Numbers and text that spells one; JSON booleans count as numbers too."""
    text = F.col("fields")[name]
    return (
        F.when(text.rlike(NUMBER_TEXT), True)
        .when(text.isin(*BOOLEANS), _json_type(name) == "BOOLEAN")
        .otherwise(False)
    )


def _iso_time(text: Column) -> Column:
    """Time of an ISO text, NULL for other texts; fractions are cut to microseconds."""
    day = F.regexp_replace(text, r"^(\d{4})(\d{2})(\d{2})", "$1-$2-$3")
    clock = F.regexp_replace(day, r"^(.{10}[T ]\d{2}):?(\d{2})", "$1:$2")
    clock = F.regexp_replace(clock, r"^(.{10}[T ]\d{2}:\d{2}):?(\d{2})", "$1:$2")
    clock = F.regexp_replace(clock, r"^(.{10}[T ]\d{2})(Z|[+-]|$)", "$1:00$2")
    clock = F.regexp_replace(clock, r"[.,](\d{1,6})\d*", ".$1")
    zone = F.regexp_replace(clock, r"([T ].*[+-]\d{2}):?(\d{2})$", "$1:$2")
    zone = F.regexp_replace(zone, r"([T ].*[+-]\d{2})$", "$1:00")
    plain = text.try_cast("timestamp")
    return F.when(text.rlike(PLAIN_TIME), plain).when(text.rlike(ISO_TIME), zone.try_cast("timestamp"))


def _bad_time() -> Column:
    text = _text("event_ts")
    iso = _iso_time(text)
    return (
        F.when(text.isNull(), False)
        .when(iso.isNotNull(), False)
        .otherwise(_json_type("event_ts") == "STRING")
    )


def _bad_fields() -> list[Column]:
    """Arrays of fields that are given but not numeric, and of required ones that are null."""
    measures = _names(tuple(f for f in NUMERIC_FIELDS if f != "seq"))
    given = lambda f: F.col("fields")[f].isNotNull()
    not_numeric = F.filter(measures, lambda f: F.when(given(f), ~_is_number(f)).otherwise(False))
    none = F.array().cast("array<string>")
    seq = _text("seq")
    bad_seq = (
        F.when(seq.isNull(), none)
        .when(
            seq.rlike(INTEGER_TEXT),  # beyond 64 bits is an error, not a silent NULL
            F.when(F.trim(seq).try_cast("long").isNull(), F.array(F.lit("seq"))).otherwise(none),
        )
        .when(~seq.rlike(NUMBER_TEXT) & ~seq.isin(*BOOLEANS), F.array(F.lit("seq")))
        .when(_json_type("seq") == "STRING", F.array(F.lit("seq")))
        .otherwise(none)
    )
    nulls = F.filter(_names(REQUIRED_FIELDS), lambda f: F.col("fields")[f].isNull())
    return [not_numeric, bad_seq, nulls]


def _number(name: str) -> Column:
    """Value of a validated numeric field."""
    text = _text(name)
    return F.coalesce(text.try_cast("double"), (text == BOOLEANS[0]).cast("double"))


def _whole_number(name: str) -> Column:
    """Value of a validated integer field; a JSON number with a fraction is truncated."""
    return F.coalesce(F.trim(_text(name)).try_cast("long"), _number(name).try_cast("long"))


def _event_time() -> Column:
    """ISO text, or a JSON number of epoch seconds."""
    text = _text("event_ts")
    micros = (text.try_cast("double") * 1_000_000).try_cast("long")
    return F.when(text.rlike(ISO_TIME), _iso_time(text)).otherwise(F.timestamp_micros(micros))


def _last_of_each(members: Column) -> Column:
    """The members with the last value of each name; the map keeps repeats in their order."""
    names = F.map_keys(members)
    last = lambda name: F.element_at(
        F.filter(F.map_entries(members), lambda e: e["key"] == name), -1
    )["value"]
    distinct = F.array_distinct(names)
    return F.when(F.size(distinct) == F.size(names), members).otherwise(
        F.map_from_arrays(distinct, F.transform(distinct, last))
    )


def parse(messages: DataFrame) -> DataFrame:
    """Decode the message body.

    Adds ``raw`` (the text, NULL for invalid UTF-8), ``fields`` (the members of
    the JSON object, as text) and ``parse_error``. The body is parsed as the only
    element of an array, so that text after the object makes it malformed.
    """
    text = F.col("data").cast("string")
    decoded = messages.withColumn("raw", F.when(F.is_valid_utf8(text), text))
    boxed = F.concat(F.lit("["), F.col("raw"), F.lit("]"))
    parsed = decoded.withColumn("_box", F.from_json(boxed, "array<map<string,string>>"))
    fields = F.when(F.size("_box") == 1, _last_of_each(F.col("_box")[0]))
    parsed = parsed.withColumn("fields", fields).drop("_box")
    error = F.when(F.col("raw").isNull(), PARSE_ERROR).when(
        F.col("fields").isNull(),
        F.when(F.json_array_length(boxed) == 1, PARSE_ERROR).otherwise(JSON_ERROR),
    )
    return parsed.withColumn("parse_error", error)


def validate(parsed: DataFrame, observed_at: str | datetime | Column | None = None) -> DataFrame:
    """Classify parsed messages; the first class that applies wins.

    Adds ``status`` (``success`` or ``error``) and the columns of the error
    record. The checks keep names of offending fields; texts are only built for
    messages that have an error.
    """
    found = parsed.withColumns(
        {
            "_missing": F.array_except(_names(REQUIRED_FIELDS), F.map_keys("fields")),
            "_bad": F.concat(*_bad_fields()),
        }
    )
    kind = (
        F.when(F.col("parse_error").isNotNull(), F.col("parse_error"))
        .when(F.size("_missing") > 0, VALIDATION_ERROR)
        .when(_bad_time(), TIMESTAMP_ERROR)
        .when(F.size("_bad") > 0, TYPE_ERROR)
    )
    # explode keeps the verdict and the members together: a filter on them is not pushed
    # below, where the parse and the checks would be repeated for every column they feed
    judged = found.withColumn("_kind", kind).select(
        "*", F.explode(F.array(_verdict(observed_at))).alias("_verdict")
    )
    carried = [c for c in parsed.columns if c != "fields"]
    return judged.select(*carried, "_verdict.*")


def _verdict(observed_at: str | datetime | Column | None) -> Column:
    kind = F.col("_kind")
    message = (
        F.when(kind == JSON_ERROR, F.lit("body is not valid JSON"))
        .when((kind == PARSE_ERROR) & F.col("raw").isNull(), F.lit("body is not valid UTF-8"))
        .when(kind == PARSE_ERROR, F.lit("body is not a JSON object"))
        .when(kind == TIMESTAMP_ERROR, F.concat(F.lit(BAD_TIME), _text("event_ts")))
    )
    missing = F.transform("_missing", lambda f: F.concat(F.lit(MISSING_FIELD), f))
    bad = F.transform(
        "_bad",
        lambda f: F.concat(
            F.lit(BAD_NUMBER), f, F.lit(": "), F.coalesce(F.col("fields")[f], F.lit("null"))
        ),
    )
    messages = F.when(kind == VALIDATION_ERROR, missing).when(kind == TYPE_ERROR, bad)
    with_record = kind.isin(VALIDATION_ERROR, TIMESTAMP_ERROR, TYPE_ERROR)
    seen = F.current_timestamp() if observed_at is None else instant(observed_at)
    return F.struct(
        F.col("fields"),
        F.when(kind.isNull(), "success").otherwise("error").alias("status"),
        kind.alias("error_type"),
        message.alias("error_message"),
        messages.alias("error_messages"),
        F.when(kind == JSON_ERROR, F.substring("raw", 1, RAW_KEPT)).alias("raw_data"),
        F.when(with_record, F.col("raw")).alias("record"),
        F.when(kind.isNotNull(), F.col("data")).alias("body"),
        seen.alias("error_ts"),
    )


def successes(validated: DataFrame) -> DataFrame:
    return validated.filter(F.col("status") == "success").drop(*ERROR_COLUMNS, "parse_error")


def errors(validated: DataFrame) -> DataFrame:
    """Error records of every class, parse and validation errors alike.

    ``raw_data`` shows the start of a malformed body; ``body`` holds every message whole, so none is
    lost, whatever was wrong with it.
    """
    return validated.filter(F.col("status") == "error").select(*ERROR_COLUMNS, "attributes")


def parse_and_validate(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid messages and error records, two branches of one plan."""
    checked = validate(parse(messages))
    return successes(checked), errors(checked)


def combine_errors(*branches: DataFrame) -> DataFrame:
    """All error records of several branches, duplicates kept."""
    combined = branches[0]
    for branch in branches[1:]:
        combined = combined.unionByName(branch, allowMissingColumns=True)
    return combined


def enrich(
    valid: DataFrame, ingest_ts: str | datetime | Column | None = None, carried: tuple[str, ...] = ()
) -> DataFrame:
    """Typed readings from valid messages, with the ``carried`` columns of the messages.

    The network profile comes from the message attributes only; missing quality
    flags become an empty list.
    """
    return valid.select(*reading_columns(ingest_ts), *carried)


def reading_columns(ingest_ts: str | datetime | Column | None = None) -> list[Column]:
    """The columns of a typed reading, from those of a valid message."""
    flags = F.from_json(_text("quality_flags"), "array<string>")
    columns = {
        "event_ts": _event_time(),
        "ingest_ts": F.current_timestamp() if ingest_ts is None else instant(ingest_ts),
        "meter_id": _text("meter_id"),
        "pole_id": _text("pole_id"),
        "seq": _whole_number("seq"),
        "quality_flags": F.coalesce(flags, F.array().cast("array<string>")),
        "network_profile": F.try_element_at(F.col("attributes"), F.lit("network_profile")),
    }
    return [columns.get(f.name, _number(f.name)).cast(f.dataType).alias(f.name) for f in READINGS]


def sorted_out(
    validated: DataFrame, ingest_ts: str | datetime | Column | None = None, carried: tuple[str, ...] = ()
) -> DataFrame:
    """Typed readings and dead letters side by side, to be kept for several sinks: the columns of a reading are
    null for an error, ``value`` (its payload) for a valid message. Neither body nor members are kept."""
    valid = F.col("status") == "success"
    typed = [
        F.when(valid, c).alias(f.name) for c, f in zip(reading_columns(ingest_ts), READINGS.fields, strict=True)
    ]
    letter = F.when(F.col("status") == "error", _payload())
    return validated.select("status", *typed, letter.alias("value"), *carried)


def sorted_readings(sorted_rows: DataFrame) -> DataFrame:
    return sorted_rows.filter(F.col("status") == "success").select(*READINGS.names)


def sorted_letters(sorted_rows: DataFrame) -> DataFrame:
    return sorted_rows.filter(F.col("status") == "error").select("value")


def json_lines(readings: DataFrame) -> DataFrame:
    """One JSON object per row, nulls spelled out."""
    return readings.select(
        F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    )


def error_bytes(error_records: DataFrame) -> DataFrame:
    """Dead-letter payloads: UTF-8 JSON. ``body`` is the whole message as it came, in base64."""
    return error_records.select(_payload().alias("value"))


def _payload() -> Column:
    return F.encode(F.to_json(F.struct(*ERROR_COLUMNS)), "UTF-8")
