"""Scheduled net load of a low-voltage feeder."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattspark.functions.columns import float_list

# Hourly multipliers and rated power of a house and a photovoltaic system.
DEMAND_SHAPE = (
    "1.0,1.0,1.0,1.0,1.0,1.0,3.0,5.0,3.0,1.0,1.0,1.0,"
    "1.0,1.0,1.0,1.0,3.0,5.0,7.0,7.0,5.0,3.0,1.0,1.0"
)
SOLAR_SHAPE = (
    "0.0,0.0,0.0,0.0,0.0,0.0,0.1,0.3,0.5,0.7,0.8,1.0,"
    "0.8,0.7,0.5,0.3,0.1,0.0,0.0,0.0,0.0,0.0,0.0,0.0"
)
HOUSE_KW = 1.0
PV_KW = 5.0


def net_load_profile(
    scenarios: DataFrame, demand: str = DEMAND_SHAPE, solar: str = SOLAR_SHAPE
) -> DataFrame:
    """Demand, solar and net power per hour of every scenario.

    ``scenarios`` has ``house_kw`` and ``pv_kw`` per row. Each row unrolls its
    two hourly shapes side by side, so no join is needed.
    """
    hours = F.arrays_zip(
        float_list(F.lit(demand)).alias("demand"), float_list(F.lit(solar)).alias("solar")
    )
    unrolled = scenarios.select("*", F.posexplode(hours).alias("hour", "_h"))
    demand_kw = F.col("house_kw") * F.col("_h.demand")
    solar_kw = F.col("pv_kw") * F.col("_h.solar")
    return unrolled.select(
        *scenarios.columns,
        F.col("hour").cast("long").alias("hour"),
        demand_kw.alias("demand_kw"),
        solar_kw.alias("solar_kw"),
        (demand_kw - solar_kw).alias("net_kw"),
    )


def net_load_summary(profile: DataFrame, scenario: str) -> DataFrame:
    """Per scenario: peak import, peak export, hours of reverse flow and daily energy."""
    net = F.col("net_kw")
    return profile.groupBy(scenario).agg(
        F.max(net).alias("peak_net_kw"),
        F.greatest(-F.min(net), F.lit(0.0)).alias("max_export_kw"),
        F.count_if(net < 0).alias("reverse_flow_hours"),
        F.sum(net).alias("net_kwh"),
    )
