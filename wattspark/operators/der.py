"""Distributed energy resources: fleet aggregation and per-device statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspark.functions.columns import safe_divide
from wattspark.operators.sliced import consecutive_pairs, with_running
from wattspark.schemas import DER_METRICS, WIND_CURVE as WIND_CURVE_SCHEMA, der_wide_schema

# Market rules.
SLOT_MINUTES = 5
MARKET_MINIMUM_KW = 100.0
# Wind speed (m/s) from 1 to power (kW) of a 95 kW machine.
CURVE_RATING_KW = 95.0
WIND_CURVE = (
    0.0, 0.0, 1.2, 7.2, 14.5, 24.7, 37.9, 58.7, 74.8, 85.1, 90.2, 94.7, 95.3,
    95.1, 94.2, 92.9, 91.2, 88.9, 87.1, 84.1, 81.3, 78.6, 75.1, 74.3, 71.7,
)
DAY = 86_400


def union_fleet(*parts: DataFrame) -> DataFrame:
    """Telemetry of different kinds of resource in one wide table."""
    wide = der_wide_schema()
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part, allowMissingColumns=True)
    extra = [c for c in combined.columns if c not in wide.fieldNames()]
    present = [
        (F.col(f.name) if f.name in combined.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in wide
    ]
    return combined.select(*present, *extra)


def metric_series(fleet: DataFrame) -> DataFrame:
    """One row per device, moment and reported metric."""
    metrics = list(dict.fromkeys(m for kind in DER_METRICS.values() for m in kind))
    keys = ["device_id", "device_type", "ts"]
    return (
        fleet.select(*keys, *[F.col(m).cast("double").alias(m) for m in metrics])
        .unpivot(keys, metrics, "metric", "value")
        .filter(F.col("value").isNotNull())
    )


def device_slots(fleet: DataFrame, minutes: int = SLOT_MINUTES) -> DataFrame:
    """Mean output of each device per slot, so that frequent samples do not count twice."""
    return (
        fleet.groupBy(
            F.window("ts", f"{minutes} minutes").alias("_w"), "device_type", "device_id"
        )
        .agg(F.avg("power_output").alias("power_kw"))
        .select(F.col("_w.start").alias("slot_start"), "device_type", "device_id", "power_kw")
    )


def fleet_slots(fleet: DataFrame, minutes: int = SLOT_MINUTES) -> DataFrame:
    """Fleet output per slot."""
    return (
        device_slots(fleet, minutes)
        .groupBy("slot_start")
        .agg(F.sum("power_kw").alias("total_kw"), F.count(F.lit(1)).alias("devices"))
    )


def fleet_slots_by_type(fleet: DataFrame, minutes: int = SLOT_MINUTES) -> DataFrame:
    """Output per slot and kind of resource; a NULL kind holds the fleet total."""
    slots = device_slots(fleet, minutes)
    start, kind = F.col("slot_start"), F.col("device_type")
    return slots.groupingSets([[start, kind], [start]], start, kind).agg(
        F.sum("power_kw").alias("total_kw"), F.count(F.lit(1)).alias("devices")
    )


def eligible_slots(
    fleet: DataFrame, minimum_kw: float = MARKET_MINIMUM_KW, minutes: int = SLOT_MINUTES
) -> DataFrame:
    """Slots in which the fleet reaches the market minimum."""
    return fleet_slots(fleet, minutes).filter(F.col("total_kw") >= minimum_kw)


def eligible_periods(
    fleet: DataFrame, minimum_kw: float = MARKET_MINIMUM_KW, minutes: int = SLOT_MINUTES
) -> DataFrame:
    """Eligible slots that follow one another, merged into periods.

    Each eligible slot also marks its successor; a successor that is not
    eligible itself ends the period.
    """
    step = F.make_dt_interval(mins=F.lit(minutes))
    marks = (
        eligible_slots(fleet, minimum_kw, minutes)
        .select(
            F.explode(
                F.array(
                    F.struct(F.col("slot_start").alias("at"), F.col("total_kw").alias("kw")),
                    F.struct(
                        (F.col("slot_start") + step).alias("at"), F.lit(None).cast("double").alias("kw")
                    ),
                )
            ).alias("_m")
        )
        .groupBy(F.col("_m.at").alias("at"))
        .agg(F.max("_m.kw").alias("kw"))
    )
    numbered = with_running(
        marks, [], ["at"], {"_run": ("sum", F.col("kw").isNull().cast("long"))}, DAY
    )
    return (
        numbered.filter(F.col("kw").isNotNull())
        .groupBy("_run")
        .agg(
            F.min("at").alias("period_start"),
            (F.max("at") + step).alias("period_end"),
            F.count(F.lit(1)).alias("slots"),
            F.min("kw").alias("min_kw"),
            F.avg("kw").alias("avg_kw"),
        )
        .drop("_run")
    )


def inventory(fleet: DataFrame, declared: DataFrame) -> DataFrame:
    """Devices seen per kind next to the declared number."""
    seen = fleet.groupBy("device_type").agg(F.count_distinct("device_id").alias("_seen"))
    return declared.join(seen, "device_type", "left").select(
        "device_type",
        "declared",
        F.coalesce("_seen", F.lit(0)).cast("long").alias("seen"),
        (F.coalesce("_seen", F.lit(0)) - F.col("declared")).cast("long").alias("difference"),
    )


def battery_cycles(fleet: DataFrame) -> DataFrame:
    """Energy delivered, discharge cycles ended and lowest capacity per battery.

    A reading holds until the next one; a cycle ends where ``dischargable``
    turns from true to false.
    """
    batteries = fleet.filter(F.col("device_type") == "battery")
    pairs = consecutive_pairs(
        batteries, ["device_id"], ["ts", "seq"], ["power_output", "dischargable"], DAY
    )
    hours = (F.unix_micros("ts") - F.unix_micros("prev_ts")) / 3_600_000_000
    ended = F.col("prev_dischargable") & ~F.col("dischargable")
    moves = pairs.groupBy("device_id").agg(
        F.sum(F.col("prev_power_output") * hours).alias("energy_kwh"),
        F.count_if(ended).alias("cycles_ended"),
    )
    base = batteries.groupBy("device_id").agg(
        F.count(F.lit(1)).alias("readings"), F.min("capacity").alias("min_capacity")
    )
    return base.join(moves, "device_id", "left").select(
        "device_id",
        "readings",
        "min_capacity",
        F.coalesce("energy_kwh", F.lit(0.0)).alias("energy_kwh"),
        F.coalesce("cycles_ended", F.lit(0)).alias("cycles_ended"),
    )


def performance_ratio() -> Column:
    """Whole percent of nominal power, cut off and not rounded."""
    return (safe_divide(F.col("power_output"), F.col("nominal_power")) * 100).cast("long")


def pv_performance(fleet: DataFrame) -> DataFrame:
    """Mean performance ratio per photovoltaic device and day."""
    return (
        fleet.filter(F.col("device_type") == "PV")
        .groupBy("device_id", F.to_date("ts").alias("event_date"))
        .agg(
            F.avg(performance_ratio()).alias("avg_performance_ratio"),
            F.max("power_output").alias("peak_power_kw"),
        )
    )


def wind_curve(spark: SparkSession) -> DataFrame:
    """The speed-to-power curve as a table."""
    return spark.createDataFrame(list(enumerate(WIND_CURVE, start=1)), WIND_CURVE_SCHEMA)


def with_curve_power(fleet: DataFrame, curve: DataFrame) -> DataFrame:
    """Wind telemetry with the output the curve promises at the reported speed.

    An ordinary join: the planner broadcasts a small curve and shuffles a large one. Speeds off the
    curve get NULL.
    """
    lookup = curve.select(
        F.col("WindSpeed").cast("long").alias("_speed"), F.col("PowerOutput").alias("_kw")
    )
    wind = fleet.filter(F.col("device_type") == "wind")
    joined = wind.join(lookup, F.col("wind_speed").cast("long") == F.col("_speed"), "left")
    expected = F.round(F.col("_kw") * F.col("nameplate_capacity") / CURVE_RATING_KW, 1)
    return joined.withColumn("expected_kw", expected).drop("_speed", "_kw")


def wind_underperformance(
    fleet: DataFrame, curve: DataFrame, tolerance: float = 0.2
) -> DataFrame:
    """Readings that fall short of the curve by more than ``tolerance``, as alert rows."""
    shortfall = F.col("expected_kw") - F.col("power_output")
    return (
        with_curve_power(fleet, curve)
        .filter(shortfall > F.col("expected_kw") * tolerance)
        .select(
            "device_id",
            "ts",
            "wind_speed",
            "power_output",
            "expected_kw",
            shortfall.alias("shortfall_kw"),
        )
    )


def flatten_edge(messages: DataFrame) -> DataFrame:
    """Edge-local wind telemetry with the location unnested and the time as a timestamp.

    Coordinates pass through under the names they arrive with.
    """
    return messages.select(
        F.timestamp_millis("timestamp").alias("ts"),
        "nameplate_capacity",
        "wind_speed",
        "power_output",
        F.col("location.longitude").alias("longitude"),
        F.col("location.latitude").alias("latitude"),
    )
