"""Pole gauges and the long metric table they are published as."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from wattspark.functions.columns import instant
from wattspark.functions.quality import is_sag, normal_share_gauge

# Gauge name and the value type it is published with.
GAUGES = {
    "voltage_avg": "double",
    "voltage_min": "double",
    "voltage_max": "double",
    "power_total_kw": "double",
    "voltage_sag_count": "int64",
    "health_score": "double",
    "active_meter_count": "int64",
}
UNKNOWN_POLE = "unknown"


def pole_key() -> Column:
    return F.coalesce("pole_id", F.lit(UNKNOWN_POLE)).alias("pole_id")


def gauge_measures() -> list[Column]:
    volts = F.col("voltage_v")
    return [
        F.avg(volts).alias("voltage_avg"),
        F.min(volts).alias("voltage_min"),
        F.max(volts).alias("voltage_max"),
        F.sum("power_kw").alias("power_total_kw"),
        F.count_if(is_sag(volts)).alias("voltage_sag_count"),
        normal_share_gauge(volts).alias("health_score"),
        F.count_distinct(F.coalesce("meter_id", F.lit(""))).alias("active_meter_count"),
    ]


def pole_gauges(readings: DataFrame, window_seconds: int = 60) -> DataFrame:
    """Seven gauges per pole and window; ``end_time`` is the end of the window."""
    return (
        readings.groupBy(
            F.window("event_ts", f"{window_seconds} seconds").alias("_w"), pole_key()
        )
        .agg(*gauge_measures())
        .withColumn("end_time", F.col("_w.end"))
        .drop("_w")
    )


def batch_gauges(readings: DataFrame, published_at: str | datetime | Column) -> DataFrame:
    """Seven gauges per pole over the whole batch, stamped ``published_at``."""
    return (
        readings.groupBy(pole_key())
        .agg(*gauge_measures())
        .withColumn("end_time", instant(published_at))
    )


def to_series(gauges: DataFrame) -> DataFrame:
    """One row per gauge value, in the layout of the metric table."""
    value_type = F.create_map(*[F.lit(x) for item in GAUGES.items() for x in item])
    values = [F.col(name).cast("double").alias(name) for name in GAUGES]
    return (
        gauges.select("pole_id", "end_time", *values)
        .unpivot(["pole_id", "end_time"], list(GAUGES), "metric", "value")
        .select(
            "metric",
            F.create_map(F.lit("pole_id"), F.col("pole_id")).alias("labels"),
            "end_time",
            "value",
            value_type[F.col("metric")].alias("value_type"),
        )
    )
