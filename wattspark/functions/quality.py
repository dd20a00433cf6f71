"""Voltage classes, severities and the three health scores in use."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from wattspark.functions.columns import (
    round_stable,
    safe_divide,
    strict_greatest,
    strict_least,
)

# Volts.
SAG_V = 220.0
SWELL_V = 260.0
WARNING_V = 210.0
CRITICAL_V = 200.0


def is_sag(voltage: Column, threshold: float = SAG_V) -> Column:
    return voltage < F.lit(threshold)


def is_swell(voltage: Column, threshold: float = SWELL_V) -> Column:
    return voltage > F.lit(threshold)


def low_voltage_flag(voltage: Column, threshold: float = SAG_V) -> Column:
    return is_sag(voltage, threshold).cast("int")


def voltage_flags(voltage: Column, sag: float = SAG_V, swell: float = SWELL_V) -> Column:
    """Quality flags a reading earns by its voltage alone."""
    return (
        F.when(is_sag(voltage, sag), F.array(F.lit("voltage_sag")))
        .when(is_swell(voltage, swell), F.array(F.lit("voltage_swell")))
        .otherwise(F.array().cast("array<string>"))
    )


def sag_severity(lowest_voltage: Column) -> Column:
    return (
        F.when(lowest_voltage < CRITICAL_V, "CRITICAL")
        .when(lowest_voltage < WARNING_V, "WARNING")
        .otherwise("MINOR")
    )


def normal_share_gauge(voltage: Column) -> Column:
    """Aggregate: percentage of readings between the sag and swell limits, both included."""
    return F.count_if(voltage.between(SAG_V, SWELL_V)) / F.count(voltage) * 100


def normal_share_score(voltage: Column) -> Column:
    """Aggregate: like the gauge, by counting the bad readings, to one decimal."""
    bad = F.count_if(is_sag(voltage) | is_swell(voltage))
    return round_stable((1 - safe_divide(bad, F.count(F.lit(1)))) * 100, 1)


def composite_score(
    readings: Column, expected: Column, bad_readings: Column, voltage_stddev: Column
) -> Column:
    """25 points completeness, 50 points voltage in band, 25 points voltage stability.

    A group of one reading has no standard deviation and so no score.
    """
    completeness = strict_least(safe_divide(readings, expected), F.lit(1.0)) * 25
    in_band = (1 - safe_divide(bad_readings, readings)) * 50
    stability = strict_greatest(F.lit(0.0), 1 - voltage_stddev / 10) * 25
    return round_stable(completeness + in_band + stability, 1)


def alert_level(score: Column) -> Column:
    return F.when(score < 50, "CRITICAL").when(score < 70, "WARNING").otherwise("OK")
