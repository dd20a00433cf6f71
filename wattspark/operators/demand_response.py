"""Demand-response baselines and event performance."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from wattspark.functions.columns import (
    day_of_week,
    hour_of_day,
    instant,
    minute_bucket,
    round_stable,
    safe_divide,
    time_of_day,
)
from wattspark.operators import filters

SLOT = ["pole_id", "hour_of_day", "minute_bucket"]
# A five-minute slot is a twelfth of an hour.
SLOTS_PER_HOUR = 12
QUANTILE_ACCURACY = 10_000


def historical_load(
    readings: DataFrame,
    as_of: str | date,
    lookback_days: int = 10,
    holidays: DataFrame | None = None,
) -> DataFrame:
    """Load and meters per pole and five-minute slot of each weekday in the lookback.

    ``holidays`` holds one ``event_date`` per day to leave out as well. It is a
    calendar, so the planner decides by its size whether to broadcast it.
    """
    ts = F.col("event_ts")
    rows = filters.weekdays(filters.lookback_days(readings, as_of, lookback_days))
    days = rows.groupBy(
        "pole_id",
        hour_of_day(ts).alias("hour_of_day"),
        minute_bucket(ts).alias("minute_bucket"),
        day_of_week(ts).alias("day_of_week"),
        F.to_date(ts).alias("event_date"),
    ).agg(
        F.sum("power_kw").alias("total_power_kw"),
        F.count_distinct("meter_id").alias("meter_count"),
    )
    return days if holidays is None else days.join(holidays, "event_date", "left_anti")


def baseline(
    readings: DataFrame,
    as_of: str | date,
    lookback_days: int = 10,
    computed_at: str | datetime | Column | None = None,
    holidays: DataFrame | None = None,
) -> DataFrame:
    """Baseline statistics per pole and slot of the day, ordered by them."""
    return slot_statistics(historical_load(readings, as_of, lookback_days, holidays), computed_at)


def slot_statistics(
    days: DataFrame, computed_at: str | datetime | Column | None = None
) -> DataFrame:
    """Baseline statistics over the load of each slot and day."""
    load = F.col("total_power_kw")
    quantiles = F.percentile_approx(load, [0.1, 0.5, 0.9], QUANTILE_ACCURACY)
    stats = days.groupBy(*SLOT).agg(
        F.avg(load).alias("baseline_avg_kw"),
        quantiles.alias("_q"),
        F.stddev(load).alias("baseline_stddev_kw"),
        round_stable(F.avg("meter_count")).cast("long").alias("avg_meter_count"),
        # one row per slot and day, so counting rows counts days
        F.count("event_date").alias("baseline_days_count"),
    )
    when = F.current_timestamp() if computed_at is None else instant(computed_at)
    return stats.select(
        *SLOT,
        time_of_day(F.col("hour_of_day"), F.col("minute_bucket")).alias("time_of_day"),
        "baseline_avg_kw",
        F.col("_q")[1].alias("baseline_median_kw"),
        F.col("_q")[0].alias("baseline_p10_kw"),
        F.col("_q")[2].alias("baseline_p90_kw"),
        "baseline_stddev_kw",
        "avg_meter_count",
        "baseline_days_count",
        when.alias("computed_at"),
    ).orderBy(*SLOT)


def event_load(
    readings: DataFrame, event_date: str | date, start_hour: int, end_hour: int
) -> DataFrame:
    """Actual load per pole and slot during an event."""
    ts = F.col("event_ts")
    return (
        filters.event_hours(readings, event_date, start_hour, end_hour)
        .groupBy(
            "pole_id",
            hour_of_day(ts).alias("hour_of_day"),
            minute_bucket(ts).alias("minute_bucket"),
        )
        .agg(F.sum("power_kw").alias("actual_power_kw"))
    )


def load_against_baseline(load: DataFrame, base: DataFrame) -> DataFrame:
    """Event load next to its baseline; slots without a baseline stay, with NULLs.

    Both sides are aggregates with at most 288 rows per pole; join strategy is
    left to the planner, which sees their sizes at run time.
    """
    expected = base.select(*SLOT, "baseline_avg_kw", "baseline_median_kw")
    reduction = F.col("baseline_avg_kw") - F.col("actual_power_kw")
    return load.join(expected, SLOT, "left").select(
        *SLOT,
        "actual_power_kw",
        "baseline_avg_kw",
        "baseline_median_kw",
        reduction.alias("load_reduction_kw"),
        (safe_divide(reduction, F.col("baseline_avg_kw")) * 100).alias("reduction_percent"),
    )


def event_performance(
    readings: DataFrame, base: DataFrame, event_date: str | date, start_hour: int, end_hour: int
) -> DataFrame:
    """Per pole reduction. Slots without a baseline add nothing but count in the divisor."""
    slots = load_against_baseline(event_load(readings, event_date, start_hour, end_hour), base)

    def per_slot(column: str) -> Column:
        return F.sum(column) / F.count(F.lit(1))

    return (
        slots.groupBy("pole_id")
        .agg(
            per_slot("actual_power_kw").alias("avg_actual_kw"),
            per_slot("baseline_avg_kw").alias("avg_baseline_kw"),
            per_slot("load_reduction_kw").alias("avg_reduction_kw"),
            F.avg("reduction_percent").alias("avg_reduction_percent"),
            (F.sum("load_reduction_kw") / SLOTS_PER_HOUR).alias("total_reduction_kwh"),
        )
        .orderBy(F.desc_nulls_last("avg_reduction_percent"))
    )


def compute_event(
    readings: DataFrame,
    base: DataFrame,
    pole_ids: Sequence[str],
    event_date: str | date,
    start_hour: int,
    end_hour: int,
) -> DataFrame:
    """Per pole reduction of the chosen poles, a missing baseline counting as zero."""
    load = event_load(filters.of_poles(readings, pole_ids), event_date, start_hour, end_hour)
    slots = load_against_baseline(load, filters.of_poles(base, pole_ids)).select(
        "pole_id",
        "actual_power_kw",
        F.coalesce("baseline_avg_kw", F.lit(0.0)).alias("baseline_kw"),
    )
    reduction = F.col("baseline_kw") - F.col("actual_power_kw")
    totals = slots.groupBy("pole_id").agg(
        F.avg("actual_power_kw").alias("actual"),
        F.avg("baseline_kw").alias("expected"),
        F.avg(reduction).alias("reduction"),
        F.sum(reduction).alias("reduction_sum"),
    )

    def shown(column: Column, digits: int) -> Column:
        return round_stable(F.coalesce(column, F.lit(0.0)), digits)

    return totals.select(
        "pole_id",
        shown(F.col("actual"), 2).alias("avg_actual_kw"),
        shown(F.col("expected"), 2).alias("avg_baseline_kw"),
        shown(F.col("reduction"), 2).alias("avg_reduction_kw"),
        shown(safe_divide(F.col("reduction"), F.col("expected")) * 100, 2).alias(
            "reduction_percent"
        ),
        shown(F.col("reduction_sum") / SLOTS_PER_HOUR, 3).alias("total_reduction_kwh"),
    ).orderBy(F.desc("total_reduction_kwh"))


def event_total(per_pole: DataFrame) -> DataFrame:
    """Total over poles of the energies as shown, to three decimals."""
    total = F.coalesce(F.sum("total_reduction_kwh"), F.lit(0.0))
    return per_pole.agg(
        F.count(F.lit(1)).alias("poles"), round_stable(total, 3).alias("total_reduction_kwh")
    )
