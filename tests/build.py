"""Small literal readings."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from wattspark.schemas import READINGS

START = datetime(2025, 12, 26, 12, 0, 0, tzinfo=timezone.utc)


def reading(second=0.0, volts=240.0, meter="m1", pole="pole_A", kw=1.0, seq=None, **more):
    at = START + timedelta(seconds=second)
    row = {
        "event_ts": at,
        "ingest_ts": at + timedelta(seconds=more.pop("delay", 0)),
        "meter_id": meter,
        "pole_id": pole,
        "seq": int(second) if seq is None else seq,
        "voltage_v": volts,
        "current_a": 5.0,
        "power_kw": kw,
        "reactive_kvar": None,
        "freq_hz": 60.0,
        "quality_flags": [],
        "network_profile": "wired",
    }
    row.update(more)
    return tuple(row[f.name] for f in READINGS)


def readings(spark, *rows):
    return spark.createDataFrame(list(rows), READINGS)


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())
