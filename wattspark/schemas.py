"""Table and message schemas. Nothing is inferred at read time."""

from __future__ import annotations

from pyspark.sql import types as T

_ts, _str, _long, _dbl = T.TimestampType(), T.StringType(), T.LongType(), T.DoubleType()


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType(
        [T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields]
    )


ENVELOPE = _struct(
    ("data", T.BinaryType()),
    ("attributes", T.MapType(_str, _str)),
    ("publish_ts", _ts),
)

READINGS = _struct(
    ("event_ts", _ts, False),
    ("ingest_ts", _ts),
    ("meter_id", _str, False),
    ("pole_id", _str, False),
    ("seq", _long),
    ("voltage_v", _dbl, False),
    ("current_a", _dbl, False),
    ("power_kw", _dbl, False),
    ("reactive_kvar", _dbl),
    ("freq_hz", _dbl),
    ("quality_flags", T.ArrayType(_str)),
    ("network_profile", _str),
)

MINUTE_AGG = _struct(
    ("pole_id", _str, False),
    ("window_start", _ts, False),
    ("reading_count", _long, False),
    ("meter_count", _long, False),
    ("avg_voltage_v", _dbl, False),
    ("min_voltage_v", _dbl, False),
    ("max_voltage_v", _dbl, False),
    ("total_power_kw", _dbl, False),
    ("avg_power_kw", _dbl, False),
)

BASELINE = _struct(
    ("pole_id", _str, False),
    ("hour_of_day", _long, False),
    ("minute_bucket", _long, False),
    ("time_of_day", _str, False),
    ("baseline_avg_kw", _dbl),
    ("baseline_median_kw", _dbl),
    ("baseline_p10_kw", _dbl),
    ("baseline_p90_kw", _dbl),
    ("baseline_stddev_kw", _dbl),
    ("avg_meter_count", _long),
    ("baseline_days_count", _long),
    ("computed_at", _ts),
)

VOLTAGE_EVENTS = _struct(
    ("event_id", _str, False),
    ("meter_id", _str, False),
    ("pole_id", _str, False),
    ("event_type", _str, False),
    ("severity", _str, False),
    ("event_start", _ts, False),
    ("event_end", _ts),
    ("duration_seconds", _long),
    ("min_voltage_v", _dbl),
    ("max_voltage_v", _dbl),
    ("avg_voltage_v", _dbl),
    ("reading_count", _long),
    ("detected_at", _ts),
)

METRICS = _struct(
    ("metric", _str, False),
    ("labels", T.MapType(_str, _str)),
    ("end_time", _ts, False),
    ("value", _dbl),
    ("value_type", _str),
)

# Telemetry message fields.
REQUIRED_FIELDS = ("event_ts", "meter_id", "pole_id", "voltage_v", "current_a", "power_kw")
NUMERIC_FIELDS = ("voltage_v", "current_a", "power_kw", "reactive_kvar", "freq_hz", "seq")
KNOWN_FIELDS = (
    "event_ts", "meter_id", "pole_id", "seq", "voltage_v", "current_a", "power_kw",
    "reactive_kvar", "freq_hz", "quality_flags", "network_profile",
)
QUALITY_FLAGS = ("estimated", "missing", "out_of_range", "voltage_sag", "voltage_swell")
NETWORK_PROFILES = ("wired", "5g", "lte_m", "satellite")
ID_PATTERN = "^[a-zA-Z0-9_-]+$"
# field: (lowest, highest) allowed by the telemetry schema
FIELD_RANGES = {
    "voltage_v": (0.0, 500.0),
    "current_a": (0.0, 200.0),
    "power_kw": (0.0, 50.0),
    "freq_hz": (45.0, 65.0),
}

# Metrics each kind of energy resource reports.
DER_METRICS = {
    "battery": {
        "capacity": "float",
        "power_output": "float",
        "run_time": "float",
        "cycle_life": "int",
        "dischargable": "boolean",
    },
    "PV": {"nominal_power": "float", "power_output": "float", "performance_ratio": "int"},
    "wind": {"nameplate_capacity": "float", "wind_speed": "float", "power_output": "float"},
}

_METRIC_TYPES = {"float": _dbl, "int": _long, "boolean": T.BooleanType()}


def der_schema(device_type: str, catalogue: dict = DER_METRICS) -> T.StructType:
    """Message schema of one kind of resource, built from the metric catalogue."""
    if device_type not in catalogue:
        raise ValueError(f"unknown device type: {device_type}")
    metrics = [(name, _METRIC_TYPES[kind]) for name, kind in catalogue[device_type].items()]
    return _struct(("device_id", _str), ("device_type", _str), ("ts", _ts), *metrics)


def der_wide_schema(catalogue: dict = DER_METRICS) -> T.StructType:
    """One schema that holds every kind of resource, absent metrics being null."""
    wide = T.StructType()
    for device_type in catalogue:
        for field in der_schema(device_type, catalogue):
            if field.name not in wide.fieldNames():
                wide = wide.add(field)
    return wide


WIND_CURVE = _struct(("WindSpeed", T.IntegerType()), ("PowerOutput", _dbl))

EDGE_WIND = _struct(
    ("timestamp", _long),
    ("nameplate_capacity", _dbl),
    ("wind_speed", T.IntegerType()),
    ("power_output", _dbl),
    ("location", _struct(("longitude", _dbl), ("latitude", _dbl))),
)
