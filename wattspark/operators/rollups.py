"""Time and pole rollups, quick looks and top-k reports over readings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from wattspark.functions.columns import (
    day_of_week,
    hour_of_day,
    instant,
    minute_bucket,
    round_stable,
    share_pct,
)
from wattspark.functions.quality import SAG_V, is_sag, normal_share_score
from wattspark.operators import filters

DAY = 86_400
HOUR = 3_600


def _measures(**columns: Column) -> list[Column]:
    return [column.alias(name) for name, column in columns.items()]


def _readings() -> Column:
    return F.count(F.lit(1))


def _meters() -> Column:
    return F.count_distinct("meter_id")


def minute_load_profile(readings: DataFrame) -> DataFrame:
    """Per pole and minute, labelled with the five-minute bucket the minute lies in."""
    ts = F.col("event_ts")
    return readings.groupBy(
        "pole_id",
        F.date_trunc("minute", ts).alias("minute_ts"),
        minute_bucket(ts).alias("minute_bucket"),
        F.to_date(ts).alias("event_date"),
        hour_of_day(ts).alias("hour_of_day"),
        day_of_week(ts).alias("day_of_week"),
    ).agg(
        *_measures(
            reading_count=_readings(),
            meter_count=_meters(),
            total_power_kw=F.sum("power_kw"),
            avg_power_kw=F.avg("power_kw"),
            max_power_kw=F.max("power_kw"),
            avg_voltage_v=F.avg("voltage_v"),
            min_voltage_v=F.min("voltage_v"),
            max_voltage_v=F.max("voltage_v"),
            stddev_voltage_v=F.stddev("voltage_v"),
            total_current_a=F.sum("current_a"),
            avg_current_a=F.avg("current_a"),
            total_reactive_kvar=F.sum("reactive_kvar"),
            avg_freq_hz=F.avg("freq_hz"),
        )
    )


def _pole_interval_measures() -> list[Column]:
    return _measures(
        reading_count=_readings(),
        meter_count=_meters(),
        avg_voltage_v=F.avg("voltage_v"),
        min_voltage_v=F.min("voltage_v"),
        max_voltage_v=F.max("voltage_v"),
        stddev_voltage_v=F.stddev("voltage_v"),
        avg_current_a=F.avg("current_a"),
        total_power_kw=F.sum("power_kw"),
        avg_power_kw=F.avg("power_kw"),
        peak_power_kw=F.max("power_kw"),
        avg_freq_hz=F.avg("freq_hz"),
    )


def pole_minute_view(readings: DataFrame) -> DataFrame:
    """The deployed pole view: one row per minute, with its five-minute bucket."""
    ts = F.col("event_ts")
    return readings.groupBy(
        "pole_id",
        F.date_trunc("minute", ts).alias("interval_start"),
        minute_bucket(ts).alias("minute_bucket"),
    ).agg(*_pole_interval_measures())


def pole_interval_rollup(readings: DataFrame, minutes: int = 5) -> DataFrame:
    """One row per pole and full interval of ``minutes``."""
    return (
        readings.groupBy("pole_id", F.window("event_ts", f"{minutes} minutes").alias("_w"))
        .agg(*_pole_interval_measures())
        .withColumn("interval_start", F.col("_w.start"))
        .drop("_w")
    )


def pole_window_stats(readings: DataFrame, window_seconds: int = 60) -> DataFrame:
    """Fixed-window statistics per pole in the layout of the minute-aggregate table."""
    return (
        readings.groupBy(F.window("event_ts", f"{window_seconds} seconds").alias("_w"), "pole_id")
        .agg(
            *_measures(
                reading_count=_readings(),
                meter_count=_meters(),
                avg_voltage_v=F.avg("voltage_v"),
                min_voltage_v=F.min("voltage_v"),
                max_voltage_v=F.max("voltage_v"),
                total_power_kw=F.sum("power_kw"),
                avg_power_kw=F.avg("power_kw"),
            )
        )
        .select(
            "pole_id",
            F.col("_w.start").alias("window_start"),
            "reading_count",
            "meter_count",
            "avg_voltage_v",
            "min_voltage_v",
            "max_voltage_v",
            "total_power_kw",
            "avg_power_kw",
        )
    )


def pole_summary(
    readings: DataFrame, pole_id: str, start: str | datetime, end: str | datetime
) -> DataFrame:
    """One summary row of a pole over a closed time range; no row without readings."""
    rows = filters.of_poles(filters.within(readings, start, end), [pole_id])
    total = _readings()
    summary = rows.agg(
        *_measures(
            meter_count=_meters(),
            reading_count=total,
            avg_voltage_v=round_stable(F.avg("voltage_v"), 2),
            min_voltage_v=round_stable(F.min("voltage_v"), 2),
            max_voltage_v=round_stable(F.max("voltage_v"), 2),
            voltage_stddev=round_stable(F.coalesce(F.stddev("voltage_v"), F.lit(0.0)), 2),
            total_power_kw=round_stable(F.sum("power_kw"), 2),
            avg_power_kw=round_stable(F.avg("power_kw"), 3),
            peak_power_kw=round_stable(F.max("power_kw"), 3),
            low_voltage_pct=share_pct(F.count_if(is_sag(F.col("voltage_v"))), total, 2),
            health_score=normal_share_score(F.col("voltage_v")),
        )
    )
    return summary.filter(F.col("reading_count") > 0).select(
        F.lit(pole_id).alias("pole_id"),
        instant(start).alias("start_time"),
        instant(end).alias("end_time"),
        "*",
    )


def count_readings(
    readings: DataFrame, as_of: str | datetime | None = None, hours: int = 24
) -> DataFrame:
    """Number of readings, of the last ``hours`` when ``as_of`` is given."""
    rows = readings if as_of is None else filters.since(readings, as_of, hours * HOUR)
    return rows.agg(_readings().alias("total_readings"))


def stats_by_pole(readings: DataFrame, as_of: str | datetime, hours: int = 1) -> DataFrame:
    return (
        filters.since(readings, as_of, hours * HOUR)
        .groupBy("pole_id")
        .agg(
            *_measures(
                meters=_meters(),
                readings=_readings(),
                avg_voltage=round_stable(F.avg("voltage_v"), 2),
                min_voltage=round_stable(F.min("voltage_v"), 2),
                max_voltage=round_stable(F.max("voltage_v"), 2),
                total_power_kw=round_stable(F.sum("power_kw"), 2),
            )
        )
        .orderBy("pole_id")
    )


def readings_by_hour(
    readings: DataFrame, as_of: str | datetime, hours: int = 24, buckets: int = 24
) -> DataFrame:
    """The newest hourly buckets with reading and meter counts."""
    return (
        filters.since(readings, as_of, hours * HOUR)
        .groupBy(F.date_trunc("hour", "event_ts").alias("hour"))
        .agg(*_measures(readings=_readings(), meters=_meters()))
        .orderBy(F.desc("hour"))
        .limit(buckets)
    )


def power_by_pole(readings: DataFrame, as_of: str | datetime, hours: int = 1) -> DataFrame:
    return (
        filters.since(readings, as_of, hours * HOUR)
        .groupBy("pole_id")
        .agg(
            *_measures(
                readings=_readings(),
                avg_voltage=F.avg("voltage_v"),
                total_power=F.sum("power_kw"),
            )
        )
    )


def active_poles(
    readings: DataFrame, as_of: str | datetime, hours: int = 24, limit: int = 100
) -> DataFrame:
    """Poles with readings in the last ``hours``, alphabetically."""
    if not 1 <= limit <= 1000:
        raise ValueError("limit must be 1 to 1000")
    return (
        filters.since(readings, as_of, hours * HOUR)
        .select("pole_id")
        .distinct()
        .orderBy("pole_id")
        .limit(limit)
    )


def newest_readings(readings: DataFrame, limit: int = 10) -> DataFrame:
    return (
        readings.orderBy(F.desc("event_ts"), "meter_id", "seq")
        .limit(limit)
        .select("event_ts", "meter_id", "pole_id", "voltage_v", "current_a", "power_kw")
    )


def newest_readings_rounded(readings: DataFrame, limit: int = 5) -> DataFrame:
    return (
        readings.orderBy(F.desc("event_ts"), "meter_id", "seq")
        .limit(limit)
        .select(
            "event_ts",
            "meter_id",
            "pole_id",
            round_stable(F.col("voltage_v"), 2).alias("voltage_v"),
            round_stable(F.col("power_kw"), 3).alias("power_kw"),
        )
    )


def newest_low_voltage(
    readings: DataFrame, limit: int = 10, threshold: float = SAG_V
) -> DataFrame:
    return (
        readings.filter(is_sag(F.col("voltage_v"), threshold))
        .orderBy(F.desc("event_ts"), "meter_id", "seq")
        .limit(limit)
        .select("meter_id", "pole_id", "event_ts", round_stable(F.col("voltage_v"), 2).alias("voltage_v"))
    )


def first_of_each(readings: DataFrame, keys: list[str], order: str = "event_ts") -> DataFrame:
    """One row per key, the earliest by ``order``: duplicate suppression for batches.

    Written as an aggregate, so copies collapse before the shuffle.
    """
    rest = [c for c in readings.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.col(order)).alias("_first")
    return readings.groupBy(*keys).agg(first).select(
        *[c if c in keys else F.col(f"_first.{c}").alias(c) for c in readings.columns]
    )
