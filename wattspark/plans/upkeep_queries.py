"""Tables kept up from partial results: baselines by day, rollups by sketch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from wattspark.operators import sketches
from wattspark.plans.demand_queries import BASE_DOUBLES, HISTORY
from wattspark.plans.projections import readings
from wattspark.plans.registry import query
from wattspark.session import scratch_dir
from wattspark.sources import baseline_days, tables

AS_OFS = [f"2024-01-{d}" for d in range(26, 31)]
LOOKBACK = 10


@query(
    "k06_baselines_by_days",
    """SELECT pole_id, hour_of_day, minute_bucket, printf('%02d:%02d', hour_of_day, minute_bucket) AS time_of_day,
  avg(total_power_kw) AS baseline_avg_kw, quantile_disc(total_power_kw, 0.5) AS baseline_median_kw,
  quantile_disc(total_power_kw, 0.1) AS baseline_p10_kw, quantile_disc(total_power_kw, 0.9) AS baseline_p90_kw,
  stddev_samp(total_power_kw) AS baseline_stddev_kw, CAST(round(avg(meter_count)) AS BIGINT) AS avg_meter_count,
  count(DISTINCT event_date) AS baseline_days_count, as_of AS computed_at
FROM history JOIN (SELECT unnest(generate_series(TIMESTAMP '2024-01-26', TIMESTAMP '2024-01-30', INTERVAL 1 DAY)) AS as_of)
  ON event_date < as_of AND event_date >= as_of - INTERVAL 10 DAY
GROUP BY pole_id, hour_of_day, minute_bucket, as_of""",
    BASE_DOUBLES,
    (HISTORY,),
)
def baselines_by_days(spark, sf_dir):
    """Five baselines, a day apart: each adds one day to the table of loads and lets the oldest go."""
    rows, path, baselines = readings(spark, sf_dir), scratch_dir(spark, "days"), []
    for as_of in AS_OFS:
        target = scratch_dir(spark, "baseline")
        baseline_days.next_day(rows, path, target, as_of, LOOKBACK, f"{as_of} 00:00:00")
        baselines.append(tables.read_baseline(spark, target))
    return reduce(DataFrame.unionByName, baselines)


@query(
    "a11_f20_sketched_days",
    """SELECT pole_id, date_trunc('day', event_ts)::TIMESTAMP AS window_start, count(*) AS reading_count,
  sum(power_kw) AS total_power_kw, min(voltage_v) AS min_voltage_v, max(voltage_v) AS max_voltage_v,
  count(DISTINCT meter_id) AS exact_meters, TRUE AS meters_within, TRUE AS median_within
FROM readings GROUP BY 1, 2""",
    "total_power_kw min_voltage_v max_voltage_v",
)
def sketched_days(spark, sf_dir):
    """Minutes to hours to days by sketches in a written table, next to the exact count of meters and the
    share of readings below the estimated median. Estimates are within four errors of the count and
    2 % of the rank."""
    rows, path = readings(spark, sf_dir), scratch_dir(spark, "minutes")
    sketches.sketched_windows(rows).write.parquet(path)
    hours = sketches.coarser(spark.read.parquet(path), 3_600)
    days = sketches.estimated(sketches.coarser(hours, 86_400), [0.5])
    place = days.select(F.col("pole_id").alias("_pole"), F.to_date("window_start").alias("_day"), "voltage_p50")
    here = F.col("pole_id").eqNullSafe(F.col("_pole")) & (F.to_date("event_ts") == F.col("_day"))
    low, high = F.col("voltage_v") < F.col("voltage_p50"), F.col("voltage_v") <= F.col("voltage_p50")
    exact = (
        rows.join(place, here)
        .groupBy("_pole", "_day")
        .agg(
            F.count_distinct("meter_id").alias("exact_meters"),
            ((F.avg(low.cast("int")) <= 0.52) & (F.avg(high.cast("int")) >= 0.48)).alias("median_within"),
        )
    )
    same = F.col("pole_id").eqNullSafe(F.col("_pole")) & (F.to_date("window_start") == F.col("_day"))
    error = F.abs(F.col("meter_count") - F.col("exact_meters"))
    return days.join(exact, same).select(
        "pole_id",
        "window_start",
        "reading_count",
        "total_power_kw",
        "min_voltage_v",
        "max_voltage_v",
        "exact_meters",
        (error <= 4 * sketches.meters_error() * F.col("exact_meters")).alias("meters_within"),
        "median_within",
    )
