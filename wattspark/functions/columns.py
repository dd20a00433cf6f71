"""Scalar column helpers with the null and division rules the operators rely on."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, functions as F


def instant(value: str | datetime | Column) -> Column:
    """A UTC timestamp column from text, a datetime, or a column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(value).cast("timestamp")


def day(value: str | date | Column) -> Column:
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("date")


def seconds_before(as_of: str | datetime | Column, seconds: float) -> Column:
    return instant(as_of) - F.make_dt_interval(secs=F.lit(float(seconds)))


def safe_divide(numerator: Column, denominator: Column) -> Column:
    """NULL where the divisor is zero or either side is NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def strict_least(a: Column, b: Column) -> Column:
    """Smaller of two values, NULL if either is NULL."""
    return F.when(a.isNotNull() & b.isNotNull(), F.least(a, b))


def strict_greatest(a: Column, b: Column) -> Column:
    """Larger of two values, NULL if either is NULL."""
    return F.when(a.isNotNull() & b.isNotNull(), F.greatest(a, b))


def round_stable(value: Column, digits: int = 0) -> Column:
    """Half-up rounding that does not depend on the order a sum was added up in.

    Rounding to nine digits first removes the noise that would tip an exact half.
    """
    return F.round(F.round(value, 9), digits)


def seconds_between(start: Column, end: Column) -> Column:
    """Whole elapsed seconds, as an elapsed-time difference and not a count of boundaries."""
    return F.timestamp_diff("SECOND", start, end)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts).cast("long")


def minute_bucket(ts: Column, minutes: int = 5) -> Column:
    """Start minute, within the hour, of the bucket the instant falls into."""
    m = F.minute(ts)
    return (m - m % minutes).cast("long")


def day_of_week(ts: Column) -> Column:
    """1 for Sunday to 7 for Saturday."""
    return F.dayofweek(ts).cast("long")


def time_of_day(hour: Column, minute: Column) -> Column:
    return F.format_string("%02d:%02d", hour, minute)


def share_pct(part: Column, whole: Column, digits: int | None = None) -> Column:
    pct = safe_divide(part, whole) * 100
    return pct if digits is None else round_stable(pct, digits)


def power_factor(active: Column, reactive: Column) -> Column:
    """Active over apparent power; NULL without reactive power."""
    return safe_divide(active, F.sqrt(active * active + reactive * reactive))


def reactive_power(active_kw: Column, factor: Column) -> Column:
    return active_kw * F.tan(F.acos(factor))


def line_current(active_kw: Column, voltage: Column, factor: Column) -> Column:
    """Amperes implied by power and voltage, 0 when either is not positive."""
    return F.when((voltage > 0) & (active_kw > 0), active_kw * 1000 / (voltage * factor)).otherwise(
        F.lit(0.0)
    )


def float_list(text: Column) -> Column:
    """``"1.0, 2.5"`` to an array of doubles."""
    return F.transform(F.split(text, ","), lambda item: F.trim(item).cast("double"))


def device_type_of(device_id: Column) -> Column:
    """Kind of resource from an id such as ``DER-wind-3``."""
    return F.split_part(device_id, F.lit("-"), F.lit(2))


def readable_prefix(data: Column, characters: int = 1000) -> Column:
    """The first characters of a binary body as text; what is not UTF-8 shows as U+FFFD."""
    return F.substring(F.make_valid_utf8(data.cast("string")), 1, characters)
