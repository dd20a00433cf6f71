"""Windowed pole statistics and gauges on a stream.

Readings are first aggregated per window, pole and meter, then per window and
pole. Meters are counted exactly, the state is bounded by the meters of the
open windows, and a busy pole spreads over its meters. Both steps run in append
mode: a window is emitted once, when the watermark passes its end.

The watermark runs ``delay`` behind the newest event time, so readings that arrive later than that
are dropped; the progress of a query counts them (``numRowsDroppedByWatermark``). How late readings
come is the source's business, so there is no default.

What is dropped need not be lost. ``late_rows`` keeps the readings of each micro-batch that may come too
late for their window, and ``correct_windows`` computes their windows anew from the stored readings; read
through ``corrected``, stream and corrections equal the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspark.functions.quality import SAG_V, SWELL_V, is_sag
from wattspark.operators import rollups
from wattspark.operators.gauges import pole_key
from wattspark.sources import sinks, tables

MESSAGE = "_message"  # key of the message that a row came in


def _per_meter(readings: DataFrame, window_seconds: int, delay: str, once_each: bool) -> DataFrame:
    volts = F.col("voltage_v")
    marked = drop_repeats(readings, delay) if once_each else readings.withWatermark("event_ts", delay)
    return (
        marked.groupBy(
            F.window("event_ts", f"{window_seconds} seconds"), pole_key(), F.col("meter_id")
        )
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(volts).alias("v_sum"),
            F.min(volts).alias("v_min"),
            F.max(volts).alias("v_max"),
            F.sum("power_kw").alias("p_sum"),
            F.count_if(is_sag(volts)).alias("n_sag"),
            F.count_if(volts.between(SAG_V, SWELL_V)).alias("n_normal"),
        )
    )


def _per_pole(per_meter: DataFrame, *measures: Column) -> DataFrame:
    return per_meter.groupBy("window", "pole_id").agg(*measures)


def pole_window_stats(
    readings: DataFrame, window_seconds: int = 60, *, delay: str, once_each: bool = False
) -> DataFrame:
    """Stream form of the per-pole window statistics; ``once_each`` drops repeats first."""
    n = F.sum("n")
    return _per_pole(
        _per_meter(readings, window_seconds, delay, once_each),
        n.alias("reading_count"),
        F.count(F.lit(1)).alias("meter_count"),
        (F.sum("v_sum") / n).alias("avg_voltage_v"),
        F.min("v_min").alias("min_voltage_v"),
        F.max("v_max").alias("max_voltage_v"),
        F.sum("p_sum").alias("total_power_kw"),
        (F.sum("p_sum") / n).alias("avg_power_kw"),
    ).select(
        "pole_id",
        F.col("window.start").alias("window_start"),
        "reading_count",
        "meter_count",
        "avg_voltage_v",
        "min_voltage_v",
        "max_voltage_v",
        "total_power_kw",
        "avg_power_kw",
    )


def pole_gauges(readings: DataFrame, window_seconds: int = 60, *, delay: str) -> DataFrame:
    """Stream form of the seven pole gauges."""
    n = F.sum("n")
    return _per_pole(
        _per_meter(readings, window_seconds, delay, False),
        (F.sum("v_sum") / n).alias("voltage_avg"),
        F.min("v_min").alias("voltage_min"),
        F.max("v_max").alias("voltage_max"),
        F.sum("p_sum").alias("power_total_kw"),
        F.sum("n_sag").alias("voltage_sag_count"),
        (F.sum("n_normal") / n * 100).alias("health_score"),
        F.count(F.lit(1)).alias("active_meter_count"),
    ).select("*", F.col("window.end").alias("end_time")).drop("window")


def message_key() -> Column:
    """Hash of a message's body, attributes and publish time, each of which may be null; never null."""
    parts = (
        F.sha2("data", 256),
        F.sha2(F.to_json(F.array_sort(F.map_entries("attributes"))), 256),
        F.unix_micros("publish_ts").cast("string"),
    )
    return F.sha2(F.concat_ws("|", *[F.coalesce(p, F.lit("-")) for p in parts]), 256)


def drop_repeats(readings: DataFrame, delay: str) -> DataFrame:
    """Keep one of the readings that came repeatedly, within the watermark.

    Repeats are of the same message where the rows carry its key (``MESSAGE``), else of the same meter,
    sequence number and time: a meter may start its numbers again. Without the key, readings that
    have no sequence number cannot be told from repeats, and all of them stay.
    """
    marked = readings.withWatermark("event_ts", delay)
    if MESSAGE in readings.columns:
        return marked.dropDuplicatesWithinWatermark([MESSAGE])
    number = F.coalesce(F.col("seq").cast("string"), F.expr("uuid()"))
    numbered = marked.withColumn("_number", number)
    return numbered.dropDuplicatesWithinWatermark(["meter_id", "_number", "event_ts"]).drop("_number")


def interval_micros(spark: SparkSession, text: str) -> int:
    """Microseconds of a time span such as ``13 hours``."""
    span = F.timestamp_micros(F.lit(0)) + F.lit(text).cast("interval")
    micros = spark.range(1).select(F.unix_micros(span)).first()[0]
    if micros is None:
        raise ValueError(f"no time span: {text}")
    return micros


class Newest:
    """Newest event time up to each micro-batch, a row a batch below ``root``; the last two are kept.

    A batch that is repeated sees what its first try saw."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def advance(self, batch: DataFrame, batch_id: int) -> tuple[int | None, int | None]:
        """Microseconds of the newest time before this batch, and with it."""
        spark = batch.sparkSession
        before = None
        if sinks.exists(spark, self.root):
            marks = spark.read.schema("newest long, batch_id long").parquet(self.root)
            before = marks.filter(F.col("batch_id") < batch_id).agg(F.max("newest")).first()[0]
        found = batch.agg(F.max(F.unix_micros("event_ts"))).first()[0]
        now = max((t for t in (before, found) if t is not None), default=None)
        mark = spark.range(1).select(F.lit(now).cast("long").alias("newest"))
        mark.write.mode("overwrite").parquet(f"{self.root}/batch_id={batch_id}")
        sinks.remove(spark, f"{self.root}/batch_id={batch_id - 2}")
        return before, now


def late_rows(path: str, window_seconds: int = 60, *, delay: str):
    """Writer of the readings of a micro-batch whose window may be closed, into a folder of the batch.

    These are all rows of windows that end by the newest time, this batch's included, less ``delay``:
    at least those that the windows' own query drops, however it cuts the stream into batches.
    """
    newest = Newest(f"{path.rstrip('/')}_newest")

    def write(batch: DataFrame, batch_id: int) -> None:
        _, now = newest.advance(batch, batch_id)
        window = F.window("event_ts", f"{window_seconds} seconds")
        rows = batch.withColumns({"_w": window, "pole_id": pole_key()})
        if now is None:
            rows = rows.limit(0)
        else:
            rows = rows.filter(F.unix_micros("_w.end") <= now - interval_micros(batch.sparkSession, delay))
        rows = rows.withColumn("window_start", F.col("_w.start")).drop("_w")
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def correct_windows(spark: SparkSession, late: str, readings: str, corrections: str, window_seconds: int = 60) -> None:
    """Compute the windows of kept late rows anew from the stored readings, and merge them by pole and start.

    Only the dates concerned are read. It may run at any time and again: it gives what is stored then.
    """
    if not sinks.exists(spark, late):
        return
    wanted = spark.read.parquet(late).select("pole_id", "window_start").distinct()
    # no more rows than there are dates; a window's readings may be of the next date
    end = F.col("window_start") + F.expr(f"INTERVAL {window_seconds} SECONDS")
    days = wanted.select(F.explode(F.array(F.to_date("window_start"), F.to_date(end)))).distinct().collect()
    stored = tables.read_readings(spark, readings).filter(F.col("event_date").isin(sorted(r[0] for r in days)))
    stored = stored.withColumns({"pole_id": pole_key(), "window_start": F.window("event_ts", f"{window_seconds} seconds")["start"]})
    rows = stored.join(wanted, ["pole_id", "window_start"], "left_semi").drop("window_start")
    stats = rollups.pole_window_stats(rows, window_seconds)
    sinks.merge_rows(stats, corrections, ("pole_id", "window_start"), "window_start")


def corrected(aggregates: DataFrame, corrections: DataFrame) -> DataFrame:
    """The aggregates with the corrected windows in place of theirs."""
    kept = aggregates.join(corrections, ["pole_id", "window_start"], "left_anti")
    return kept.unionByName(corrections.select(*aggregates.columns))
