"""Rollups that can be rolled up further: distinct meters and voltage quantiles as mergeable sketches.

Counts of distinct meters and quantiles of a short window say nothing about a longer one. The sketches do:
minutes become hours and hours days without a reading being read again. A HyperLogLog sketch of ``2**lg_k``
registers has a standard error of 1.04 / sqrt(2**lg_k), 1.6 % at 12; small counts are next to exact. A KLL
sketch of ``k`` 400 puts a quantile within 1 % of its rank, whatever the number of rows. Both have a bounded size
and combine before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

LG_K = 12
QUANTILE_K = 400


def meters_error(lg_k: int = LG_K) -> float:
    """Relative standard error of the count of meters."""
    return 1.04 / 2 ** (lg_k / 2)


def sketched_windows(readings: DataFrame, window_seconds: int = 60) -> DataFrame:
    """Per pole and window: additive measures, and sketches of the meters and of the voltage.

    Rows of one window may be written in parts, by batch for instance, as parts merge; a part must not
    be written twice. Readings without a time are in no window.
    """
    return _shown(
        readings.groupBy("pole_id", F.window("event_ts", f"{window_seconds} seconds").alias("_w")).agg(
            F.count(F.lit(1)).alias("reading_count"),
            F.sum("power_kw").alias("total_power_kw"),
            F.min("voltage_v").alias("min_voltage_v"),
            F.max("voltage_v").alias("max_voltage_v"),
            F.hll_sketch_agg("meter_id", LG_K).alias("meters_sketch"),
            F.kll_sketch_agg_double("voltage_v", QUANTILE_K).alias("voltage_sketch"),
        )
    )


def coarser(windows: DataFrame, window_seconds: int) -> DataFrame:
    """Longer windows of the same columns, from shorter ones that divide them."""
    return _shown(
        windows.groupBy("pole_id", F.window("window_start", f"{window_seconds} seconds").alias("_w")).agg(
            F.sum("reading_count").alias("reading_count"),
            F.sum("total_power_kw").alias("total_power_kw"),
            F.min("min_voltage_v").alias("min_voltage_v"),
            F.max("max_voltage_v").alias("max_voltage_v"),
            F.hll_union_agg("meters_sketch").alias("meters_sketch"),
            F.kll_merge_agg_double("voltage_sketch").alias("voltage_sketch"),
        )
    )


def _shown(windows: DataFrame) -> DataFrame:
    measures = [c for c in windows.columns if c not in ("pole_id", "_w")]
    return windows.select("pole_id", F.col("_w.start").alias("window_start"), *measures)


def voltage_quantile(share: float) -> Column:
    """Estimated quantile of a window's voltage; NULL where no reading has one."""
    sketch = F.col("voltage_sketch")
    found = F.kll_sketch_get_n_double(sketch) > 0
    return F.when(found, F.kll_sketch_get_quantile_double(sketch, F.lit(share)))


def estimated(windows: DataFrame, shares: Sequence[float] = (0.1, 0.5, 0.9)) -> DataFrame:
    """The windows with the number of meters and voltage quantiles (``voltage_p10`` ...) in place of sketches."""
    quantiles = [voltage_quantile(s).alias(f"voltage_p{round(100 * s):02d}") for s in shares]
    meters = F.hll_sketch_estimate("meters_sketch").alias("meter_count")
    return windows.select("*", meters, *quantiles).drop("meters_sketch", "voltage_sketch")
