"""Voltage events: sustained sags and swells, and the rolling alert."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from wattspark.functions.columns import instant, round_stable, seconds_between
from wattspark.functions.quality import (
    CRITICAL_V,
    SAG_V,
    SWELL_V,
    is_sag,
    is_swell,
    low_voltage_flag,
    sag_severity,
)
from wattspark.operators import filters
from wattspark.operators.sliced import DAY, with_running, with_trailing_count
from wattspark.schemas import VOLTAGE_EVENTS

ORDER = ("event_ts", "seq")


def number_readings(
    readings: DataFrame, threshold: float = SAG_V, slice_seconds: int = DAY
) -> DataFrame:
    """Position of each reading within its meter and within its meter and voltage class.

    ``island_id`` is their difference: it stays the same over consecutive
    readings of one class.
    """
    flagged = readings.withColumn(
        "is_low_voltage", F.coalesce(low_voltage_flag(F.col("voltage_v"), threshold), F.lit(0))
    )
    low = F.col("is_low_voltage").cast("long")
    counted = with_running(
        flagged,
        ["meter_id"],
        ORDER,
        {"rn": ("sum", F.lit(1).cast("long")), "_rn_low": ("sum", low)},
        slice_seconds,
    )
    rn_group = F.when(F.col("is_low_voltage") == 1, F.col("_rn_low")).otherwise(
        F.col("rn") - F.col("_rn_low")
    )
    return (
        counted.withColumn("rn_group", rn_group)
        .withColumn("island_id", F.col("rn") - F.col("rn_group"))
        .drop("_rn_low")
    )


def with_runs(marked: DataFrame, slice_seconds: int, max_gap_seconds: int | None) -> DataFrame:
    """Number each reading's run, ``_run``, by what ended runs of its meter before: a reading that is no
    ``_hit``, or one that comes more than ``max_gap_seconds`` after the one before it."""
    ends = ~F.col("_hit")
    if max_gap_seconds is not None:
        if max_gap_seconds < 1:
            raise ValueError("max_gap_seconds must be at least 1")
        newest = {"_before": ("max", F.col("event_ts"))}
        marked = with_running(marked, ["meter_id"], ORDER, newest, slice_seconds, inclusive=False)
        gap = F.unix_micros("event_ts") - F.unix_micros("_before") > max_gap_seconds * 1_000_000
        ends = ends | F.coalesce(gap, F.lit(False))
    return with_running(marked, ["meter_id"], ORDER, {"_run": ("sum", ends.cast("long"))}, slice_seconds)


def sustained_events(
    readings: DataFrame,
    condition: Column,
    min_duration_seconds: int,
    slice_seconds: int = DAY,
    max_gap_seconds: int | None = None,
) -> DataFrame:
    """Runs of consecutive readings of a meter that meet ``condition``.

    A run is identified by how many readings of the meter outside the condition
    came before it. A change of pole splits the run; time without readings does
    only if it is longer than ``max_gap_seconds``.
    """
    if min_duration_seconds < 1:
        raise ValueError("min_duration_seconds must be at least 1")
    hit = F.coalesce(condition, F.lit(False))
    marked = readings.select("meter_id", "pole_id", "event_ts", "seq", "voltage_v", hit.alias("_hit"))
    numbered = with_runs(marked, slice_seconds, max_gap_seconds)
    return (
        numbered.filter("_hit")
        .groupBy("meter_id", "pole_id", "_run")
        .agg(
            F.min("event_ts").alias("event_start"),
            F.max("event_ts").alias("event_end"),
            F.min("voltage_v").alias("min_voltage_v"),
            F.max("voltage_v").alias("max_voltage_v"),
            F.avg("voltage_v").alias("avg_voltage_v"),
            F.count(F.lit(1)).alias("reading_count"),
        )
        .drop("_run")
        .withColumn(
            "duration_seconds",
            seconds_between(F.col("event_start"), F.col("event_end")) + 1,
        )
        .filter(F.col("duration_seconds") >= min_duration_seconds)
    )


def sag_events(
    readings: DataFrame,
    threshold: float = SAG_V,
    min_duration_seconds: int = 5,
    slice_seconds: int = DAY,
    max_gap_seconds: int | None = None,
) -> DataFrame:
    """Sustained low voltage with a severity by the lowest reading."""
    return sustained_events(
        readings, is_sag(F.col("voltage_v"), threshold), min_duration_seconds, slice_seconds, max_gap_seconds
    ).withColumn("severity", sag_severity(F.col("min_voltage_v")))


def swell_events(
    readings: DataFrame,
    threshold: float = SWELL_V,
    min_duration_seconds: int = 5,
    slice_seconds: int = DAY,
    max_gap_seconds: int | None = None,
) -> DataFrame:
    """Sustained high voltage. No severity scale is defined for it: always MINOR."""
    return sustained_events(
        readings, is_swell(F.col("voltage_v"), threshold), min_duration_seconds, slice_seconds, max_gap_seconds
    ).withColumn("severity", F.lit("MINOR"))


def critical_sag_events(readings: DataFrame, slice_seconds: int = DAY) -> DataFrame:
    """Below 200 V for three seconds or more."""
    return sag_events(readings, CRITICAL_V, 3, slice_seconds)


def recent_sag_events(
    readings: DataFrame,
    as_of: str | date,
    days: int = 1,
    threshold: float = SAG_V,
    min_duration_seconds: int = 5,
) -> DataFrame:
    """The anomaly report: sags since ``days`` before ``as_of``, newest first."""
    recent = filters.since_date(readings, as_of, days)
    return sag_events(recent, threshold, min_duration_seconds).orderBy(
        F.desc("event_start"), "meter_id"
    )


def anomalies(
    readings: DataFrame,
    start: str | datetime,
    end: str | datetime,
    min_duration_seconds: int = 5,
    limit: int = 100,
) -> DataFrame:
    """The newest sags in a closed time range, voltages to two decimals."""
    if not 1 <= limit <= 1000:
        raise ValueError("limit must be 1 to 1000")
    events = sag_events(filters.within(readings, start, end), SAG_V, min_duration_seconds)
    newest = events.orderBy(F.desc("event_start"), "meter_id", "pole_id").limit(limit)
    return newest.select(
        "meter_id",
        "pole_id",
        "event_start",
        "event_end",
        "duration_seconds",
        round_stable(F.col("min_voltage_v"), 2).alias("min_voltage_v"),
        round_stable(F.col("avg_voltage_v"), 2).alias("avg_voltage_v"),
        "severity",
    )


def rolling_low_voltage(
    readings: DataFrame,
    seconds: int = 4,
    threshold: float = SAG_V,
    slice_seconds: int = DAY,
) -> DataFrame:
    """Low readings of the meter in the trailing ``seconds``, the current one included."""
    return with_trailing_count(
        readings,
        ["meter_id"],
        "event_ts",
        F.coalesce(is_sag(F.col("voltage_v"), threshold), F.lit(False)),
        seconds,
        "low_voltage_count",
        slice_seconds,
    )


def rolling_alerts(
    readings: DataFrame,
    seconds: int = 4,
    min_count: int = 5,
    threshold: float = SAG_V,
    slice_seconds: int = DAY,
) -> DataFrame:
    """Distinct moments at which the trailing count reached ``min_count``, newest first."""
    counted = rolling_low_voltage(readings, seconds, threshold, slice_seconds)
    return (
        counted.filter(F.col("low_voltage_count") >= min_count)
        .select(
            "meter_id",
            "pole_id",
            F.col("event_ts").alias("alert_time"),
            F.col("voltage_v").alias("current_voltage"),
        )
        .distinct()
        .orderBy(F.desc("alert_time"), "meter_id")
    )


def event_rows(events: DataFrame, event_type: str, detected_at: str | datetime | Column) -> DataFrame:
    """Events in the layout of the voltage-event table, with a reproducible id."""
    if event_type not in ("sag", "swell"):
        raise ValueError("event_type must be sag or swell")
    key = F.concat_ws(
        "|",
        "meter_id",
        "pole_id",
        F.date_format("event_start", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.lit(event_type),
    )
    filled = events.withColumns(
        {
            "event_id": F.sha2(key, 256),
            "event_type": F.lit(event_type),
            "severity": F.lower("severity"),
            "detected_at": instant(detected_at),
        }
    )
    return filled.select(*[F.col(f.name).cast(f.dataType) for f in VOLTAGE_EVENTS])
