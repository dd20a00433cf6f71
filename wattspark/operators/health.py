"""Hourly and daily pole health."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from wattspark.functions.columns import (
    hour_of_day,
    power_factor,
    round_stable,
    safe_divide,
    share_pct,
)
from wattspark.functions.quality import (
    alert_level,
    composite_score,
    is_sag,
    is_swell,
)
from wattspark.operators import filters

HOURLY = ["pole_id", "event_date", "hour_of_day"]


def hourly_metrics(
    readings: DataFrame, as_of: str | datetime | None = None, hours: int = 24
) -> DataFrame:
    """Seventeen aggregates per pole and hour, of the last ``hours`` when ``as_of`` is given."""
    rows = readings if as_of is None else filters.since(readings, as_of, hours * 3600)
    ts, volts = F.col("event_ts"), F.col("voltage_v")
    return rows.groupBy(
        "pole_id", F.to_date(ts).alias("event_date"), hour_of_day(ts).alias("hour_of_day")
    ).agg(
        F.count(F.lit(1)).alias("total_readings"),
        F.count_distinct("meter_id").alias("active_meters"),
        F.avg(volts).alias("avg_voltage_v"),
        F.min(volts).alias("min_voltage_v"),
        F.max(volts).alias("max_voltage_v"),
        F.stddev(volts).alias("voltage_stddev"),
        F.count_if(is_sag(volts)).alias("low_voltage_count"),
        F.count_if(is_swell(volts)).alias("high_voltage_count"),
        F.count_if(F.array_size("quality_flags") > 0).alias("flagged_readings"),
        F.sum("power_kw").alias("total_power_kw"),
        F.avg("power_kw").alias("avg_power_per_meter_kw"),
        F.max("power_kw").alias("peak_meter_power_kw"),
        F.sum("reactive_kvar").alias("total_reactive_kvar"),
        F.avg("freq_hz").alias("avg_freq_hz"),
        F.min("freq_hz").alias("min_freq_hz"),
        F.max("freq_hz").alias("max_freq_hz"),
    )


def with_expected_readings(metrics: DataFrame, sample_interval_seconds: float = 1) -> DataFrame:
    """Readings an hour should hold at the sampling interval, as a column of the same row."""
    per_hour = 3600 / sample_interval_seconds
    expected = F.col("active_meters") * F.lit(per_hour)
    return metrics.withColumn("expected_readings", round_stable(expected).cast("long"))


def with_expected_readings_joined(
    metrics: DataFrame, sample_interval_seconds: float = 1
) -> DataFrame:
    """The same by an equi-join on pole, date and hour, for expectations kept in a table."""
    expected = with_expected_readings(metrics, sample_interval_seconds).select(
        *HOURLY, "expected_readings"
    )
    return metrics.join(expected, HOURLY)


def hourly_health(
    readings: DataFrame,
    as_of: str | datetime | None = None,
    hours: int = 24,
    sample_interval_seconds: float = 1,
) -> DataFrame:
    """The hourly report: completeness, voltage and power quality, composite score."""
    metrics = with_expected_readings(
        hourly_metrics(readings, as_of, hours), sample_interval_seconds
    )
    total, expected = F.col("total_readings"), F.col("expected_readings")
    low, high = F.col("low_voltage_count"), F.col("high_voltage_count")
    return metrics.select(
        *HOURLY,
        "active_meters",
        "total_readings",
        "expected_readings",
        share_pct(total, expected, 2).alias("data_completeness_pct"),
        (expected - total).alias("missing_readings"),
        "avg_voltage_v",
        "min_voltage_v",
        "max_voltage_v",
        F.col("voltage_stddev").alias("voltage_volatility"),
        share_pct(low, total, 2).alias("low_voltage_pct"),
        share_pct(high, total, 2).alias("high_voltage_pct"),
        "total_power_kw",
        "avg_power_per_meter_kw",
        "peak_meter_power_kw",
        power_factor(F.col("total_power_kw"), F.col("total_reactive_kvar")).alias(
            "estimated_power_factor"
        ),
        "avg_freq_hz",
        (F.col("max_freq_hz") - F.col("min_freq_hz")).alias("freq_range_hz"),
        composite_score(total, expected, low + high, F.col("voltage_stddev")).alias(
            "health_score"
        ),
    )


def daily_health(hourly: DataFrame) -> DataFrame:
    """Daily rollup of the hourly report."""
    total, expected = F.sum("total_readings"), F.sum("expected_readings")
    return hourly.groupBy("pole_id", "event_date").agg(
        F.max("active_meters").alias("max_active_meters"),
        F.avg("active_meters").alias("avg_active_meters"),
        total.alias("total_readings"),
        expected.alias("expected_readings"),
        round_stable(safe_divide(total, expected) * 100, 2).alias("data_completeness_pct"),
        F.avg("avg_voltage_v").alias("daily_avg_voltage_v"),
        F.min("min_voltage_v").alias("daily_min_voltage_v"),
        F.max("max_voltage_v").alias("daily_max_voltage_v"),
        F.avg("low_voltage_pct").alias("avg_low_voltage_pct"),
        F.max("low_voltage_pct").alias("peak_low_voltage_hour_pct"),
        (F.sum("total_power_kw") / 24).alias("avg_hourly_power_kw"),
        F.max("total_power_kw").alias("peak_hour_power_kw"),
        F.avg("health_score").alias("avg_health_score"),
        F.min("health_score").alias("min_health_score"),
        F.count_if(F.col("health_score") < 70).alias("problem_hours_count"),
    )


def health_alerts(hourly: DataFrame, below: float = 70, limit: int = 100) -> DataFrame:
    """The worst hours: lowest score first, then newest."""
    return (
        hourly.filter(F.col("health_score") < below)
        .orderBy(F.asc("health_score"), F.desc("event_date"), F.desc("hour_of_day"), "pole_id")
        .limit(limit)
        .select(
            *HOURLY,
            "health_score",
            "data_completeness_pct",
            "low_voltage_pct",
            "avg_voltage_v",
            "min_voltage_v",
            alert_level(F.col("health_score")).alias("alert_level"),
        )
    )
