"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspark.schemas import ENVELOPE, READINGS, der_wide_schema


def message_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Messages with attributes, from a folder that receives Parquet files."""
    reader = spark.readStream.schema(ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def from_kafka(records: DataFrame) -> DataFrame:
    """Kafka records in the message layout; headers become attributes."""
    attributes: Column = F.map_from_entries(
        F.transform(
            "headers", lambda h: F.struct(h["key"].alias("k"), h["value"].cast("string").alias("v"))
        )
    )
    return records.select(
        F.col("value").alias("data"),
        attributes.alias("attributes"),
        F.col("timestamp").alias("publish_ts"),
    )


def readings_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(READINGS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def der_stream(spark: SparkSession, path: str) -> DataFrame:
    """Device telemetry from topic folders ``DER/<device_type>`` under ``path``."""
    rows = spark.readStream.schema(der_wide_schema()).json(f"{path}/DER/*")
    topic = F.regexp_extract(F.col("_metadata.file_path"), r"(DER/[^/]+)/[^/]*$", 1)
    return rows.withColumn("topic", topic)
