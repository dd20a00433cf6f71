"""Time, key and date filters, written so that scans can prune and push them down."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from wattspark.functions.columns import day, day_of_week, hour_of_day, instant, seconds_before

# Sunday and Saturday.
WEEKEND = (1, 7)


def _prune(df: DataFrame, condition: Column) -> DataFrame:
    """Repeat a date condition on the partition column where the table has one."""
    return df.filter(condition) if "event_date" in df.columns else df


def within(
    df: DataFrame,
    start: str | datetime | Column,
    end: str | datetime | Column,
    closed: bool = True,
    ts: str = "event_ts",
) -> DataFrame:
    """Rows from ``start`` to ``end``, the end included unless ``closed`` is false."""
    lo, hi = instant(start), instant(end)
    upper = F.col(ts) <= hi if closed else F.col(ts) < hi
    pruned = _prune(df, F.col("event_date").between(lo.cast("date"), hi.cast("date")))
    return pruned.filter((F.col(ts) >= lo) & upper)


def since(df: DataFrame, as_of: str | datetime, seconds: float, ts: str = "event_ts") -> DataFrame:
    """Rows of the last ``seconds`` before ``as_of``, and any later ones."""
    lo = seconds_before(as_of, seconds)
    return _prune(df, F.col("event_date") >= lo.cast("date")).filter(F.col(ts) >= lo)


def since_date(df: DataFrame, as_of: str | date, days: int, ts: str = "event_ts") -> DataFrame:
    """Rows dated ``days`` before ``as_of`` or later."""
    lo = F.date_sub(day(as_of), days)
    return _prune(df, F.col("event_date") >= lo).filter(F.col(ts) >= lo.cast("timestamp"))


def lookback_days(df: DataFrame, as_of: str | date, days: int, ts: str = "event_ts") -> DataFrame:
    """Rows of the ``days`` whole days before ``as_of``; that day itself is left out."""
    hi = day(as_of)
    lo = F.date_sub(hi, days)
    pruned = _prune(df, (F.col("event_date") >= lo) & (F.col("event_date") < hi))
    return pruned.filter((F.col(ts) >= lo.cast("timestamp")) & (F.col(ts) < hi.cast("timestamp")))


def weekdays(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    return df.filter(~day_of_week(F.col(ts)).isin(*WEEKEND))


def of_poles(df: DataFrame, pole_ids: Sequence[str]) -> DataFrame:
    return df.filter(F.col("pole_id").isin(*pole_ids))


def event_hours(
    df: DataFrame, event_date: str | date, start_hour: int, end_hour: int, ts: str = "event_ts"
) -> DataFrame:
    """Readings of one day from ``start_hour`` up to, not including, ``end_hour``.

    An end of 24 reaches midnight. The hours become one time range, which the
    scan can use.
    """
    if not 0 <= start_hour <= 23 or not 0 <= end_hour <= 24:
        raise ValueError("start_hour must be 0 to 23 and end_hour 0 to 24")
    midnight = day(event_date).cast("timestamp")
    hours = lambda n: F.make_dt_interval(hours=F.lit(n))
    pruned = _prune(df, F.col("event_date") == day(event_date))
    return pruned.filter(
        (F.col(ts) >= midnight + hours(start_hour)) & (F.col(ts) < midnight + hours(end_hour))
    )


def hour_range(df: DataFrame, start_hour: int, end_hour: int, ts: str = "event_ts") -> DataFrame:
    """The same half-open hour range on every day."""
    h = hour_of_day(F.col(ts))
    return df.filter((h >= start_hour) & (h < end_hour))
