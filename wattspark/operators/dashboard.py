"""Dashboard series over the long metric table and over readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values: (state, direction, limit) of each tile.
THRESHOLDS = {
    "backlog": [("YELLOW", "ABOVE", 100), ("RED", "ABOVE", 1000)],
    "processing_lag": [("YELLOW", "ABOVE", 30), ("RED", "ABOVE", 120)],
    "voltage_sag_count": [("YELLOW", "ABOVE", 5), ("RED", "ABOVE", 20)],
    "health_score": [("YELLOW", "BELOW", 95), ("RED", "BELOW", 80)],
}
# Reference lines of the voltage tile.
VOLTAGE_LINES = (220.0, 240.0)
SEVERITY = ("RED", "YELLOW")

ALIGNERS = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}


def align(series: DataFrame, metric: str, how: str = "mean", seconds: int = 60) -> DataFrame:
    """One value per time series and period."""
    if how not in ALIGNERS:
        raise ValueError(f"how must be one of {sorted(ALIGNERS)}")
    return (
        series.filter(F.col("metric") == metric)
        .groupBy(
            F.window("end_time", f"{seconds} seconds").alias("_w"),
            F.col("labels")["pole_id"].alias("pole_id"),
        )
        .agg(ALIGNERS[how]("value").alias("value"))
        .select(F.col("_w.start").alias("period_start"), "pole_id", "value")
    )


def align_and_reduce(
    series: DataFrame, metric: str, how: str, reduce: str, seconds: int = 60
) -> DataFrame:
    """Align each series, then combine the series of a period into one."""
    aligned = align(series, metric, how, seconds)
    return aligned.groupBy("period_start").agg(ALIGNERS[reduce]("value").alias("value"))


def voltage_distribution(series: DataFrame, seconds: int = 60) -> DataFrame:
    """Lowest, mean and highest voltage of each pole and period in one pass."""
    def of(metric: str, how: str, name: str) -> Column:
        return ALIGNERS[how](F.when(F.col("metric") == metric, F.col("value"))).alias(name)

    return (
        series.filter(F.col("metric").isin("voltage_min", "voltage_avg", "voltage_max"))
        .groupBy(
            F.window("end_time", f"{seconds} seconds").alias("_w"),
            F.col("labels")["pole_id"].alias("pole_id"),
        )
        .agg(
            of("voltage_min", "min", "voltage_min"),
            of("voltage_avg", "mean", "voltage_avg"),
            of("voltage_max", "max", "voltage_max"),
        )
        .select(
            F.col("_w.start").alias("period_start"),
            "pole_id",
            "voltage_min",
            "voltage_avg",
            "voltage_max",
        )
    )


def arrival_rate(readings: DataFrame, ts: str = "ingest_ts", seconds: int = 60) -> DataFrame:
    """Rows per second over each period."""
    return (
        readings.groupBy(F.window(ts, f"{seconds} seconds").alias("_w"))
        .agg((F.count(F.lit(1)) / F.lit(seconds)).alias("rate_per_second"))
        .select(F.col("_w.start").alias("period_start"), "rate_per_second")
    )


def processing_lag(readings: DataFrame, seconds: int = 60) -> DataFrame:
    """Longest delay, in seconds, between event and arrival of each period."""
    lag = (F.unix_micros("ingest_ts") - F.unix_micros("event_ts")) / 1_000_000
    return (
        readings.groupBy(F.window("ingest_ts", f"{seconds} seconds").alias("_w"))
        .agg(F.max(lag).alias("lag_seconds"))
        .select(F.col("_w.start").alias("period_start"), "lag_seconds")
    )


def tile_state(value: Column, tile: str) -> Column:
    """GREEN, YELLOW or RED; the most severe rule that holds wins."""
    state = F.when(value.isNull(), F.lit(None).cast("string"))
    rules = THRESHOLDS[tile]
    for colour in SEVERITY:
        for name, direction, limit in rules:
            if name == colour:
                state = state.when(value > limit if direction == "ABOVE" else value < limit, colour)
    return state.otherwise("GREEN")


def voltage_band(value: Column) -> Column:
    """Where a voltage lies against the reference lines of its tile."""
    low, nominal = VOLTAGE_LINES
    return (
        F.when(value < low, "BELOW_LIMIT").when(value < nominal, "BELOW_NOMINAL").otherwise("NOMINAL")
    )
