"""Checks of the full telemetry schema, reported and never enforced."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wattspark.schemas import (
    FIELD_RANGES,
    ID_PATTERN,
    KNOWN_FIELDS,
    NETWORK_PROFILES,
    QUALITY_FLAGS,
)


def rules() -> dict[str, Column]:
    """Violation name to the condition under which a reading commits it."""
    found = {
        "meter_id_pattern": ~F.col("meter_id").rlike(ID_PATTERN),
        "pole_id_pattern": ~F.col("pole_id").rlike(ID_PATTERN),
        "seq_missing": F.col("seq").isNull(),
        "seq_negative": F.col("seq") < 0,
    }
    for field, (low, high) in FIELD_RANGES.items():
        found[f"{field}_range"] = ~F.col(field).between(low, high)
    allowed = F.array(*[F.lit(flag) for flag in QUALITY_FLAGS])
    found["quality_flags_enum"] = F.size(F.array_except("quality_flags", allowed)) > 0
    found["network_profile_enum"] = ~F.col("network_profile").isin(*NETWORK_PROFILES)
    return found


def violations(readings: DataFrame) -> DataFrame:
    """Readings with the list of schema rules each one breaks."""
    broken = [F.when(condition, F.lit(name)) for name, condition in rules().items()]
    return readings.withColumn("violations", F.array_compact(F.array(*broken)))


def violation_counts(readings: DataFrame) -> DataFrame:
    return (
        violations(readings)
        .select(F.explode("violations").alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("readings"))
    )


def unknown_properties(parsed: DataFrame) -> DataFrame:
    """Parsed messages with the properties the schema does not know."""
    known = F.array(*[F.lit(name) for name in KNOWN_FIELDS])
    return parsed.withColumn(
        "unknown_properties", F.array_sort(F.array_except(F.map_keys("fields"), known))
    )
