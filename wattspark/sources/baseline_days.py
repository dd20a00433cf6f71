"""Baselines kept up day by day: a table of each day's load per slot, from which any baseline is finished.

A new day reads its own readings alone. The readings of the lookback are never read again, only their
load: at most 288 rows per pole and day.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspark.functions.columns import day
from wattspark.operators import demand_response as dr
from wattspark.schemas import READINGS
from wattspark.sources import sinks


def add_days(readings: DataFrame, path: str, as_of: str | date, days: int = 1) -> None:
    """Write the load of the ``days`` whole days before ``as_of`` into the table, one folder a date.

    A date that is written again, after late readings for instance, replaces its own folder and no other,
    so a repeat changes nothing. Weekends have no load, and a date without readings leaves what is there.
    """
    load = dr.historical_load(readings, as_of, days)
    ranged = load.repartitionByRange("event_date", "pole_id").sortWithinPartitions("event_date", *dr.SLOT)
    sinks.replacing(ranged, ("event_date",)).parquet(path)


def load_of_days(spark: SparkSession, path: str, as_of: str | date, lookback_days: int) -> DataFrame:
    """The load of the lookback; only its dates are read."""
    layout = dr.historical_load(spark.createDataFrame([], READINGS), as_of).schema
    hi = day(as_of)
    dates = (F.col("event_date") >= F.date_sub(hi, lookback_days)) & (F.col("event_date") < hi)
    return spark.read.schema(layout).parquet(path).filter(dates)


def baseline(
    spark: SparkSession,
    path: str,
    as_of: str | date,
    lookback_days: int = 10,
    computed_at: str | datetime | Column | None = None,
    holidays: DataFrame | None = None,
) -> DataFrame:
    """What ``demand_response.baseline`` gives for the same readings, from the table of days."""
    load = load_of_days(spark, path, as_of, lookback_days)
    if holidays is not None:
        load = load.join(holidays, "event_date", "left_anti")
    return dr.slot_statistics(load, computed_at)


def next_day(
    readings: DataFrame,
    path: str,
    target: str,
    as_of: str | date,
    lookback_days: int = 10,
    computed_at: str | datetime | Column | None = None,
) -> None:
    """Add the day before ``as_of``, replace the baseline table ``target``, and drop the dates it no longer needs.

    The first call, on a table without days, adds the whole lookback. Each step may be repeated.
    """
    spark = readings.sparkSession
    add_days(readings, path, as_of, 1 if sinks.exists(spark, path) else lookback_days)
    sinks.replace_table(baseline(spark, path, as_of, lookback_days, computed_at), target)
    sinks.drop_expired(spark, path, as_of, lookback_days)
