"""Batch sources. Every read names its schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wattspark.schemas import BASELINE, EDGE_WIND, READINGS, WIND_CURVE
from wattspark.sources.sinks import ARCHIVE_OPTIONS, LAYOUT, current


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """The readings table, with its partition column ``event_date`` for pruning."""
    dated = T.StructType([*READINGS.fields, T.StructField("event_date", T.DateType())])
    return spark.read.schema(dated).parquet(path).select(*dated.names)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Any table in folders of dates, without the columns of its folders."""
    return spark.read.parquet(path).drop(*LAYOUT)


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BASELINE).parquet(current(spark, path))


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Replay of the raw archive: compressed JSON lines back to readings.

    The pole is a folder of the archive and comes from partition discovery.
    """
    rows = spark.read.schema(READINGS).options(**ARCHIVE_OPTIONS).json(path)
    return rows.select(*READINGS.names)


def read_wind_curve(spark: SparkSession, path: str) -> DataFrame:
    """Wind speed to power lookup from CSV with a header."""
    return spark.read.option("header", True).schema(WIND_CURVE).csv(path)


def edge_messages(texts: DataFrame, column: str = "value") -> DataFrame:
    """Edge-local wind telemetry from a column of JSON text."""
    return texts.select(F.from_json(column, EDGE_WIND).alias("_m")).select("_m.*")
