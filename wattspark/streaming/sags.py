"""Sag events on a stream.

Each micro-batch reduces its readings to runs of low voltage with the sliced
batch operator, so a busy meter spreads over its time slices. What may still
grow is carried to the next batch in a table under the shared state folder: the
open run of each meter, and the readings newer than the watermark. Folders are
named by batch and overwritten by a retry, which makes every step repeatable.

The watermark runs ``delay_seconds`` behind the newest reading. Readings that come later still, or
have no time, are not evaluated: they are kept aside in a table of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wattspark.functions.columns import seconds_between
from wattspark.functions.quality import SAG_V, is_sag, sag_severity
from wattspark.operators.sliced import DAY
from wattspark.operators.voltage import with_runs
from wattspark.sources import sinks

COLUMNS = ("meter_id", "pole_id", "event_ts", "seq", "voltage_v")
RUN = ("meter_id", "pole_id", "event_start", "event_end", "v_min", "v_max", "v_sum", "n")


def _merge_runs(runs: DataFrame) -> DataFrame:
    return runs.groupBy("meter_id", "pole_id", "_run").agg(
        F.min("event_start").alias("event_start"),
        F.max("event_end").alias("event_end"),
        F.min("v_min").alias("v_min"),
        F.max("v_max").alias("v_max"),
        F.sum("v_sum").alias("v_sum"),
        F.sum("n").alias("n"),
    )


def _as_events(runs: DataFrame, min_duration_seconds: int) -> DataFrame:
    return (
        runs.select(
            "meter_id",
            "pole_id",
            "event_start",
            "event_end",
            F.col("v_min").alias("min_voltage_v"),
            F.col("v_max").alias("max_voltage_v"),
            (F.col("v_sum") / F.col("n")).alias("avg_voltage_v"),
            F.col("n").alias("reading_count"),
            (seconds_between(F.col("event_start"), F.col("event_end")) + 1).alias(
                "duration_seconds"
            ),
            sag_severity(F.col("v_min")).alias("severity"),
        )
        .filter(F.col("duration_seconds") >= min_duration_seconds)
    )


class SagState:
    """Folders of the carried tables, and the step that advances them by one batch."""

    def __init__(
        self,
        root: str,
        delay_seconds: int,
        threshold: float = SAG_V,
        min_duration_seconds: int = 5,
        slice_seconds: int = DAY,
        max_gap_seconds: int | None = None,
    ):
        self.root = root.rstrip("/")
        self.threshold = threshold
        self.min_duration_seconds = min_duration_seconds
        self.delay_seconds = delay_seconds
        self.slice_seconds = slice_seconds
        self.max_gap_seconds = max_gap_seconds

    def _folder(self, kind: str, batch_id: int) -> str:
        return f"{self.root}/{kind}/batch_id={batch_id}"

    def _carried(self, spark: SparkSession, kind: str, batch_id: int) -> DataFrame | None:
        path = self._folder(kind, batch_id)
        return spark.read.parquet(path) if sinks.exists(spark, path) else None

    def step(self, batch: DataFrame, batch_id: int) -> None:
        fresh = batch.select(*COLUMNS).persist()
        try:
            self._advance(fresh, batch_id)
        finally:
            fresh.unpersist()

    def _advance(self, fresh: DataFrame, batch_id: int) -> None:
        spark = fresh.sparkSession
        mark = self._carried(spark, "mark", batch_id - 1)
        pending = self._carried(spark, "pending", batch_id - 1)
        open_runs = self._carried(spark, "open", batch_id - 1)

        # one row each: the watermark so far and the newest reading of this batch
        last = mark.first() if mark is not None else None
        newest = fresh.agg(F.max(F.unix_micros("event_ts"))).first()[0]
        seen = [t for t in (newest, last["newest"] if last else None) if t is not None]
        if not seen:
            return
        high = max(seen)
        cutoff = high - self.delay_seconds * 1_000_000
        time_us = F.unix_micros("event_ts")
        # older than what was evaluated before, or without a time
        in_time = time_us > last["cutoff"] if last else time_us.isNotNull()
        late = fresh.filter(~F.coalesce(in_time, F.lit(False)))
        late.write.mode("overwrite").parquet(self._folder("late", batch_id))
        rows = fresh.filter(in_time)
        if pending is not None:
            rows = rows.unionByName(pending)
        ready = rows.filter(time_us <= cutoff).withColumn(
            "_hit", F.coalesce(is_sag(F.col("voltage_v"), self.threshold), F.lit(False))
        )

        counted = with_runs(ready, self.slice_seconds, self.max_gap_seconds)
        numbered = counted.filter("_hit")
        volts = F.col("voltage_v")
        runs = numbered.groupBy("meter_id", "pole_id", "_run").agg(
            F.min("event_ts").alias("event_start"),
            F.max("event_ts").alias("event_end"),
            F.min(volts).alias("v_min"),
            F.max(volts).alias("v_max"),
            F.sum(volts).alias("v_sum"),
            F.count(F.lit(1)).alias("n"),
        )
        if open_runs is not None:
            runs = _merge_runs(runs.unionByName(self._continued(open_runs, ready)))
        ends = counted.groupBy("meter_id").agg(F.max("_run").alias("_ends"))
        # a run is over once its meter reported normal voltage after it, or nothing for too long
        over = F.col("_run") < F.coalesce("_ends", F.lit(0))
        if self.max_gap_seconds is not None:
            over = over | (cutoff - F.unix_micros("event_end") > self.max_gap_seconds * 1_000_000)
        placed = runs.join(ends, "meter_id", "left").withColumn("_over", over)
        placed.select(*RUN, "_over").write.mode("overwrite").parquet(
            self._folder("runs", batch_id)
        )
        placed = spark.read.parquet(self._folder("runs", batch_id))
        _as_events(placed.filter("_over"), self.min_duration_seconds).write.mode(
            "overwrite"
        ).parquet(self._folder("events", batch_id))
        placed.filter(~F.col("_over")).select(*RUN).write.mode("overwrite").parquet(
            self._folder("open", batch_id)
        )
        rows.filter(time_us > cutoff).write.mode("overwrite").parquet(
            self._folder("pending", batch_id)
        )
        spark.range(1).select(
            F.lit(high).cast("long").alias("newest"), F.lit(cutoff).cast("long").alias("cutoff")
        ).write.mode("overwrite").parquet(self._folder("mark", batch_id))
        for kind in ("runs", "open", "pending", "mark"):
            if sinks.exists(spark, self._folder(kind, batch_id - 2)):
                sinks.remove(spark, self._folder(kind, batch_id - 2))

    def _continued(self, open_runs: DataFrame, ready: DataFrame) -> DataFrame:
        """Open runs as the first of their meter, or as one before it where the next reading comes too late."""
        if self.max_gap_seconds is None:
            return open_runs.withColumn("_run", F.lit(0).cast("long"))
        firsts = ready.groupBy("meter_id").agg(F.min("event_ts").alias("_first"))
        gap = F.unix_micros("_first") - F.unix_micros("event_end") > self.max_gap_seconds * 1_000_000
        run = F.when(F.coalesce(gap, F.lit(False)), -1).otherwise(0).cast("long")
        return open_runs.join(firsts, "meter_id", "left").withColumn("_run", run).drop("_first")

    def events(self, spark: SparkSession) -> DataFrame:
        """Events that are over."""
        return spark.read.parquet(f"{self.root}/events").drop("batch_id")

    def late(self, spark: SparkSession) -> DataFrame:
        """Readings that came too late, with the batch they came in."""
        return spark.read.parquet(f"{self.root}/late")

    def last_batch(self, spark: SparkSession) -> int:
        return spark.read.parquet(f"{self.root}/mark").agg(F.max("batch_id")).first()[0]

    def open_events(self, spark: SparkSession, batch_id: int | None = None) -> DataFrame:
        """Events still going on after a batch, the last by default, as they stand."""
        batch_id = self.last_batch(spark) if batch_id is None else batch_id
        return _as_events(
            spark.read.parquet(self._folder("open", batch_id)), self.min_duration_seconds
        )


def start_sag_events(
    readings: DataFrame, state: SagState, checkpoint: str, once: bool = False
) -> StreamingQuery:
    writer = readings.writeStream.foreachBatch(state.step).option("checkpointLocation", checkpoint)
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime="30 seconds").start()
