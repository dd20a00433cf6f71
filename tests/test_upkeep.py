"""Baselines kept up by days, and rollups by mergeable sketches."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.build import reading, readings, rows
from wattspark.operators import demand_response as dr, sketches
from wattspark.schemas import READINGS
from wattspark.sources import baseline_days, sinks, tables

MONDAY = datetime(2025, 3, 3, 9, 0, tzinfo=timezone.utc)


def days_of_load(spark, days, factor=1.0):
    """Three meters at two slots of two poles, on consecutive days."""
    made = []
    for d in days:
        for m in range(3):
            at = MONDAY + timedelta(days=d, minutes=5 * (m % 2))
            kw = factor * (1.0 + d + m / 10)
            made.append(reading(meter=f"m{m}", pole=f"p{m % 2}", kw=kw, event_ts=at))
    return readings(spark, *made)


def test_each_new_day_gives_the_whole_baseline(spark, tmp_path):
    table, target = str(tmp_path / "days"), str(tmp_path / "baseline")
    for day in range(5, 10):
        as_of = (MONDAY + timedelta(days=day)).date().isoformat()
        seen = days_of_load(spark, range(day))
        baseline_days.next_day(days_of_load(spark, [day - 1]) if day > 5 else seen, table, target, as_of, 5, as_of)
        assert shown(tables.read_baseline(spark, target)) == shown(dr.baseline(seen, as_of, 5, as_of))
    kept = {f.rsplit("=")[-1] for f in sinks.folders(spark, f"{table}/event_date=*")}
    # Friday to Tuesday, of which the weekend has no load
    assert kept == {"2025-03-07", "2025-03-10", "2025-03-11"}


def test_a_day_written_again_is_replaced(spark, tmp_path):
    table = str(tmp_path / "days")
    baseline_days.add_days(days_of_load(spark, range(4)), table, "2025-03-07", 4)
    for _ in range(2):
        baseline_days.add_days(days_of_load(spark, [3], factor=2.0), table, "2025-03-07")
    both = days_of_load(spark, range(3)).unionByName(days_of_load(spark, [3], factor=2.0))
    got = baseline_days.baseline(spark, table, "2025-03-07", 4, "2025-03-07")
    assert shown(got) == shown(dr.baseline(both, "2025-03-07", 4, "2025-03-07"))


def test_no_days_no_baseline(spark, tmp_path):
    table = str(tmp_path / "days")
    baseline_days.add_days(spark.createDataFrame([], READINGS), table, "2025-03-07", 4)
    assert baseline_days.baseline(spark, table, "2025-03-07").count() == 0


def test_holidays_are_left_out_of_the_days(spark, tmp_path):
    table = str(tmp_path / "days")
    baseline_days.add_days(days_of_load(spark, range(4)), table, "2025-03-07", 4)
    off = spark.sql("SELECT DATE'2025-03-04' AS event_date")
    got = baseline_days.baseline(spark, table, "2025-03-07", 4, "2025-03-07", off)
    want = dr.baseline(days_of_load(spark, range(4)), "2025-03-07", 4, "2025-03-07", off)
    assert shown(got) == shown(want)


def shown(df):
    """Rows without the noise of adding up in another order."""
    return [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(df)]


def many_readings(spark, n, meters):
    at = F.timestamp_seconds(F.lit(1_741_000_000 // 3600 * 3600) + F.col("id") % 3600)
    return spark.range(n).select(
        F.lit("p1").alias("pole_id"),
        at.alias("event_ts"),
        F.concat(F.lit("m"), F.col("id") % meters).alias("meter_id"),
        F.lit(1.0).alias("power_kw"),
        (F.pmod(F.hash("id"), F.lit(10_000)) / 100).alias("voltage_v"),
    )


def test_merged_sketches_stay_within_their_error(spark):
    seen = many_readings(spark, 200_000, 50_000)
    hour = sketches.estimated(sketches.coarser(sketches.sketched_windows(seen), 3600)).first()
    assert hour.reading_count == 200_000 and hour.total_power_kw == 200_000.0
    assert hour.meter_count == pytest.approx(50_000, rel=4 * sketches.meters_error())
    for share, estimate in ((0.1, hour.voltage_p10), (0.5, hour.voltage_p50), (0.9, hour.voltage_p90)):
        assert estimate == pytest.approx(100 * share, abs=2)  # voltages are uniform over 0 to 100


def test_parts_of_a_window_merge_and_nulls_count_for_nothing(spark):
    def without(seq, column):
        return F.when(~F.col("seq").isin(seq), F.col(column)).alias(column)

    seen = readings(spark, *(reading(i, v, m) for i, (v, m) in enumerate([(230.0, "m1"), (0.0, "m1"), (250.0, "m2"), (240.0, "m3"), (0.0, "x")])))
    seen = seen.select("pole_id", "event_ts", "power_kw", "seq", without([1, 4], "voltage_v"), without([4], "meter_id"))
    parts = [sketches.sketched_windows(seen.where(part)) for part in ("seq < 3", "seq >= 3")]
    row = sketches.estimated(sketches.coarser(parts[0].unionByName(parts[1]), 60), [0.5]).first()
    assert (row.reading_count, row.meter_count, row.voltage_p50) == (5, 3, 240.0)
    silent = sketches.sketched_windows(seen.where("seq = 4"))
    row = sketches.estimated(sketches.coarser(silent, 60), [0.5]).first()
    assert (row.reading_count, row.meter_count, row.voltage_p50) == (1, 0, None)
    assert sketches.sketched_windows(seen.limit(0)).count() == 0
