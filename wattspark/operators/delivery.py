"""Delivery quality: losses, reordering, latency, completeness and electrical consistency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wattspark.functions.columns import line_current, reactive_power, safe_divide
from wattspark.functions.quality import voltage_flags
from wattspark.operators.quantiles import exact_quantiles
from wattspark.operators.sliced import DAY, consecutive_pairs, with_running

# Declared backhaul latency in milliseconds (lowest, highest, jitter).
LATENCY_BANDS = {
    "wired": (5, 30, 10),
    "5g": (20, 200, 50),
    "lte_m": (50, 300, 100),
    "satellite": (300, 900, 200),
}
# Seconds between readings of each sampling preset.
SAMPLING_PRESETS = {"high_frequency": 30, "standard": 300, "low_frequency": 900}
DAY_SECONDS = 86_400

# Daily load curve, hour of day and kilowatts; straight lines in between.
LOAD_CURVE = (
    (0.0, 0.4), (5.0, 0.4), (6.0, 2.5), (9.0, 2.5), (10.0, 1.0),
    (16.0, 1.0), (17.0, 4.0), (21.0, 4.0), (22.0, 0.4), (24.0, 0.4),
)
PROFILE = "network_profile"


def sequence_gaps(readings: DataFrame) -> DataFrame:
    """Per meter: first and last sequence number, numbers seen and numbers missing."""
    return (
        readings.groupBy("meter_id")
        .agg(
            F.min("seq").alias("first_seq"),
            F.max("seq").alias("last_seq"),
            F.count_distinct("seq").alias("seen"),
        )
        .withColumn("lost", F.col("last_seq") - F.col("first_seq") + 1 - F.col("seen"))
    )


def delivery_stats(readings: DataFrame, slice_seconds: int = DAY) -> DataFrame:
    """Received, lost and reordered readings and the receive rate per network profile.

    A loss is charged to the reading that reveals it. A reading is reordered
    when one of its meter with a higher sequence number arrived earlier.
    """
    slim = readings.select("meter_id", "event_ts", "ingest_ts", "seq", PROFILE)
    pairs = consecutive_pairs(
        slim, ["meter_id"], ["event_ts", "seq"], ["seq", PROFILE], slice_seconds
    )
    gap = F.greatest(F.col("seq") - F.col("prev_seq") - 1, F.lit(0))
    arrivals = with_running(
        slim,
        ["meter_id"],
        ["ingest_ts", "event_ts", "seq"],
        {"_highest": ("max", F.col("seq"))},
        slice_seconds,
        inclusive=False,
    )
    reordered = F.count_if(F.col("seq") < F.col("_highest"))
    none = F.lit(0).cast("long")

    def part(df: DataFrame, **sums: Column) -> DataFrame:
        cols = {name: sums.get(name, F.max(none)) for name in ("received", "lost", "reordered")}
        cols["first_us"] = sums.get("first_us", F.max(F.lit(None).cast("long")))
        cols["last_us"] = sums.get("last_us", F.max(F.lit(None).cast("long")))
        return df.groupBy(PROFILE).agg(*[c.alias(n) for n, c in cols.items()])

    arrived_us = F.unix_micros("ingest_ts")
    parts = (
        part(
            slim,
            received=F.count(F.lit(1)),
            first_us=F.min(arrived_us),
            last_us=F.max(arrived_us),
        )
        .unionByName(part(pairs, lost=F.sum(gap)))
        .unionByName(part(arrivals, reordered=reordered))
    )
    seconds = (F.max("last_us") - F.min("first_us")) / 1_000_000
    received, lost = F.sum("received"), F.sum("lost")
    return parts.groupBy(PROFILE).agg(
        received.alias("received"),
        lost.alias("lost"),
        F.sum("reordered").alias("reordered"),
        safe_divide(lost, received + lost).alias("loss_rate"),
        F.round(received / F.greatest(seconds, F.lit(1.0)), 6).alias("rate_per_second"),
    )


def latency_ms() -> Column:
    return (F.unix_micros("ingest_ts") - F.unix_micros("event_ts")) / 1000


def out_of_band(latency: Column) -> Column:
    """Whether a latency lies outside the band declared for the profile; NULL without one."""
    result = F.when(F.lit(False), F.lit(None).cast("boolean"))
    for name, (low, high, jitter) in LATENCY_BANDS.items():
        outside = ~latency.between(max(1, low - jitter), high + jitter)
        result = result.when(F.col(PROFILE) == name, outside)
    return result


def latency_by_profile(readings: DataFrame) -> DataFrame:
    ms = F.col("latency_ms")
    slim = readings.select(PROFILE, latency_ms().alias("latency_ms"))
    p95 = exact_quantiles(slim, [PROFILE], "latency_ms", {"p95_latency_ms": 0.95})
    p95 = p95.withColumnRenamed(PROFILE, "_profile")
    stats = (
        slim.groupBy(PROFILE)
        .agg(
            F.count(F.lit(1)).alias("readings"),
            F.avg(ms).alias("avg_latency_ms"),
            F.min(ms).alias("min_latency_ms"),
            F.max(ms).alias("max_latency_ms"),
            F.count_if(out_of_band(ms)).alias("out_of_band"),
        )
    )
    joined = stats.join(p95, F.col(PROFILE).eqNullSafe(F.col("_profile")), "left")
    return joined.select(
        PROFILE, "readings", "avg_latency_ms", "min_latency_ms", "max_latency_ms", "p95_latency_ms", "out_of_band"
    )


def meter_day_completeness(readings: DataFrame, preset: str = "high_frequency") -> DataFrame:
    """Readings per meter and day against the number the sampling preset implies."""
    if preset not in SAMPLING_PRESETS:
        raise ValueError(f"preset must be one of {sorted(SAMPLING_PRESETS)}")
    expected = F.lit(DAY_SECONDS // SAMPLING_PRESETS[preset]).cast("long")
    return (
        readings.groupBy("meter_id", F.to_date("event_ts").alias("event_date"))
        .agg(F.count(F.lit(1)).alias("readings"))
        .withColumn("expected_readings", expected)
        .withColumn("completeness", safe_divide(F.col("readings"), F.col("expected_readings")))
    )


def reading_gaps(
    readings: DataFrame,
    interval_seconds: int = 30,
    tolerance: float = 2.0,
    slice_seconds: int = DAY,
) -> DataFrame:
    """Silences longer than ``tolerance`` sampling intervals, with the readings missed in each."""
    pairs = consecutive_pairs(
        readings, ["meter_id"], ["event_ts", "seq"], ["pole_id"], slice_seconds
    )
    silence = F.unix_micros("event_ts") - F.unix_micros("prev_event_ts")
    step = interval_seconds * 1_000_000
    return pairs.filter(silence > int(tolerance * step)).select(
        "meter_id",
        "pole_id",
        F.col("prev_event_ts").alias("gap_start"),
        F.col("event_ts").alias("gap_end"),
        F.floor((silence - 1) / step).cast("long").alias("missing_readings"),
    )


def derive_flags(readings: DataFrame) -> DataFrame:
    """Quality flags recomputed from the voltage."""
    return readings.withColumn("quality_flags", voltage_flags(F.col("voltage_v")))


def electrical_consistency(readings: DataFrame, factor: Column) -> DataFrame:
    """Current and reactive power implied by the other measurements, and their residuals."""
    amps = line_current(F.col("power_kw"), F.col("voltage_v"), factor)
    kvar = reactive_power(F.col("power_kw"), factor)
    return readings.withColumns(
        {
            "implied_current_a": amps,
            "implied_reactive_kvar": kvar,
            "current_residual_a": F.col("current_a") - amps,
            "reactive_residual_kvar": F.col("reactive_kvar") - kvar,
        }
    )


def fractional_hour(ts: Column) -> Column:
    return F.hour(ts) + F.minute(ts) / 60 + F.second(ts) / 3600


def expected_load(hour: Column, curve: tuple = LOAD_CURVE) -> Column:
    """Load curve at an hour of the day, straight lines between its points."""
    segments = list(zip(curve, curve[1:]))
    result = None
    for (h0, kw0), (h1, kw1) in segments:
        at = F.lit(kw0) if kw0 == kw1 else kw0 + (hour - h0) * ((kw1 - kw0) / (h1 - h0))
        condition = (hour >= h0) & (hour < h1)
        result = F.when(condition, at) if result is None else result.when(condition, at)
    return result


def load_against_curve(readings: DataFrame) -> DataFrame:
    """Each reading next to the typical load of its time of day."""
    expected = expected_load(fractional_hour(F.col("event_ts")))
    return readings.withColumn("expected_kw", expected).withColumn(
        "load_factor", safe_divide(F.col("power_kw"), F.col("expected_kw"))
    )
