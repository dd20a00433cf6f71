"""The ingest pipeline: one message stream to archive, table, dead letters and metrics."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wattspark.operators import gauges, ingest
from wattspark.sources import sinks
from wattspark.streaming import windows


def _run(writer, once: bool, interval: str):
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)


def valid_readings(messages: DataFrame) -> DataFrame:
    return ingest.enrich(ingest.parse_and_validate(messages)[0])


def keyed_readings(messages: DataFrame) -> DataFrame:
    """Valid readings with the key of the message that each came in."""
    keyed = messages.withColumn(windows.MESSAGE, windows.message_key())
    return ingest.enrich(ingest.parse_and_validate(keyed)[0], carried=(windows.MESSAGE,))


def dead_letters(messages: DataFrame) -> DataFrame:
    return ingest.error_bytes(ingest.parse_and_validate(messages)[1])


def start_archive(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    once: bool = False,
    folders: tuple[str, ...] = sinks.ARCHIVE_FOLDERS,
    files_per_folder: int = 4,
) -> StreamingQuery:
    """Compressed JSON lines, one set of files a minute.

    A repeated micro-batch replaces its own files. A folder's rows of a micro-batch go to
    ``files_per_folder`` tasks by meter, so a pole that dominates is spread; lower it where batches are
    small. Leave trailing ``folders`` out where minutes hold only a few readings.
    """
    stream = stream_name(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.archive_batch(batch, path, stream, batch_id, folders, files_per_folder)

    writer = readings.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _run(writer, once, "1 minute").start()


def stream_name(checkpoint: str) -> str:
    """Name of a stream in the folders of its tables, which tells its batches from others'."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:12]


def start_table(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    ts: str = "event_ts",
    must_exist: bool = True,
    once: bool = False,
) -> StreamingQuery:
    """Append to a table partitioned by date, which may hold rows already and have other writers.

    A repeated micro-batch replaces its own files. Batches are named after the checkpoint.
    """
    if must_exist:
        sinks.require_table(rows.sparkSession, path)
    writer = (
        rows.writeStream.outputMode("append")
        .foreachBatch(table_writer(path, checkpoint, ts))
        .option("checkpointLocation", checkpoint)
    )
    return _run(writer, once, "30 seconds").start()


def table_writer(path: str, name: str, ts: str = "event_ts") -> Callable[[DataFrame, int], None]:
    """Writer of micro-batches to a table; ``name`` tells this stream's batches from others'."""
    stream = stream_name(name)

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.append_batch(batch, path, stream, batch_id, ts)

    return write


def start_dead_letters(
    payloads: DataFrame, path: str | None, checkpoint: str, once: bool = False
) -> StreamingQuery | None:
    """Error payloads; without a path the errors are dropped and nothing starts."""
    if path is None:
        return None
    writer = (
        payloads.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _run(writer, once, "30 seconds").start()


def start_minute_aggregates(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    window_seconds: int = 60,
    once: bool = False,
    *,
    delay: str,
    once_each: bool = False,
) -> StreamingQuery:
    """Per-pole window statistics, the table being created if needed."""
    stats = windows.pole_window_stats(readings, window_seconds, delay=delay, once_each=once_each)
    return start_table(stats, path, checkpoint, "window_start", must_exist=False, once=once)


def pane_writer(path: str, window_seconds: int = 60, delay: str | None = None) -> Callable[[DataFrame, int], None]:
    """Writer of discarding panes: each holds only the readings of its micro-batch.

    With a ``delay`` a pane has its kind in ``pane``, by the watermark, which is the newest time less the
    delay: ``LATE`` if the window was closed before the batch, ``ON_TIME`` if the batch closes it, else
    ``EARLY``. The on-time pane so holds only what came since the last early one. A repeated batch
    overwrites its own folder, so a retry adds nothing twice.
    """
    newest = windows.Newest(f"{path.rstrip('/')}_newest")

    def write(batch: DataFrame, batch_id: int) -> None:
        series = gauges.to_series(gauges.pole_gauges(batch, window_seconds))
        if delay is not None:
            micros = windows.interval_micros(batch.sparkSession, delay)
            marks = [F.lit(None if t is None else t - micros).cast("long") for t in newest.advance(batch, batch_id)]
            closed, closing = (F.coalesce(F.unix_micros("end_time") <= t, F.lit(False)) for t in marks)
            series = series.withColumn("pane", F.when(closed, "LATE").when(closing, "ON_TIME").otherwise("EARLY"))
        series.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def start_gauge_panes(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    window_seconds: int = 60,
    once: bool = False,
    delay: str | None = None,
    flush_seconds: int | None = None,
) -> StreamingQuery:
    """Gauges of each pane into the metric table, a pane every half window or every ``flush_seconds``.

    What comes between two flushes is buffered by the source; after a stop, ``once`` flushes the rest.
    """
    writer = readings.writeStream.foreachBatch(pane_writer(path, window_seconds, delay)).option(
        "checkpointLocation", checkpoint
    )
    return _run(writer, once, f"{flush_seconds or max(1, window_seconds // 2)} seconds").start()


def start_gauges(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    window_seconds: int = 60,
    once: bool = False,
    *,
    delay: str,
) -> StreamingQuery:
    """Final gauges of each closed window into the metric table."""
    series = gauges.to_series(windows.pole_gauges(readings, window_seconds, delay=delay))
    writer = (
        series.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _run(writer, once, "60 seconds").start()


def start_fan_out(
    stream: DataFrame,
    writers: dict[str, Callable[[DataFrame, int], None]],
    checkpoint: str,
    once: bool = False,
    interval: str = "30 seconds",
) -> StreamingQuery:
    """Several sinks from one computation of each micro-batch.

    Every writer gets the whole batch, unchanged. The batch is persisted on the
    executors and recomputed where one is lost.
    """

    def write_all(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for write in writers.values():
                write(batch, batch_id)
        finally:
            batch.unpersist()

    writer = stream.writeStream.foreachBatch(write_all).option("checkpointLocation", checkpoint)
    return _run(writer, once, interval).start()


SPAN = "_span"  # of a message's publish time, in parts of a day; -1 without one
SPAN_HOURS = 6


def _publish_span() -> Column:
    return F.coalesce(F.floor(F.unix_micros("publish_ts") / (SPAN_HOURS * 3_600_000_000)), F.lit(-1)).cast("long")


class Delivered:
    """Keys of the messages of earlier micro-batches, in folders of publish time and batch under ``root``.

    A message that is delivered again has the publish time it had, so a batch looks only into the spans
    of its own messages: what it reads does not grow with ``within``. A message is dropped only if its key is
    known, never for its age, so what comes late for the first time passes. A batch's keys are kept
    until the newest publish time of the batches that followed is more than ``within`` past the newest one
    up to that batch; a message that comes again after that is taken for new. A publish time later than
    its arrival counts as the arrival, so that one wrong clock cannot hold up what is forgotten. A retry of
    a batch sees what its first try saw.
    """

    def __init__(self, spark: SparkSession, root: str, within: str):
        self.root = root.rstrip("/")
        self.micros = windows.interval_micros(spark, within)

    def _marks(self, spark: SparkSession, batch_id: int) -> dict[int, int | None]:
        """Newest publish time up to each earlier batch that is still kept: a row a batch."""
        if not sinks.exists(spark, f"{self.root}/marks"):
            return {}
        marks = spark.read.schema("newest long, batch_id long").parquet(f"{self.root}/marks")
        return {r.batch_id: r.newest for r in marks.filter(F.col("batch_id") < batch_id).collect()}

    def _known(self, marks: dict[int, int | None]) -> list[int]:
        newest = marks[max(marks)] if marks else None
        return [b for b, m in marks.items() if newest is None or m is None or m >= newest - self.micros]

    def reads(self, batch: DataFrame, batch_id: int) -> list[str]:
        """The folders whose keys a batch is compared with."""
        spark = batch.sparkSession
        known = set(self._known(self._marks(spark, batch_id)))
        spans = [r[0] for r in batch.select(_publish_span()).distinct().collect()]  # a row a span of the batch
        found = [f for n in spans for f in sinks.folders(spark, f"{self.root}/keys/{SPAN}={n}/batch_id=*")]
        return [f for f in found if int(f.rsplit("=", 1)[1]) in known]

    def first_time(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """One of each message that no earlier batch brought, with its key."""
        fresh = batch.withColumn(windows.MESSAGE, windows.message_key()).dropDuplicates([windows.MESSAGE])
        paths = self.reads(batch, batch_id)
        if not paths:
            return fresh
        known = batch.sparkSession.read.schema(f"{windows.MESSAGE} string").parquet(*paths)
        return fresh.join(known, windows.MESSAGE, "left_anti")

    def remember(self, fresh: DataFrame, batch_id: int, arrival: datetime | None = None) -> None:
        """Keep the keys of a batch once its sinks are written, and forget what is out of reach."""
        spark = fresh.sparkSession
        marks = self._marks(spark, batch_id)
        now = int((arrival or datetime.now(timezone.utc)).timestamp() * 1_000_000)
        newest = fresh.agg(F.max(F.least(F.unix_micros("publish_ts"), F.lit(now)))).first()[0]
        seen = [t for t in (newest, marks[max(marks)] if marks else None) if t is not None]
        keys = fresh.select(windows.MESSAGE, _publish_span().alias(SPAN), F.lit(batch_id).alias("batch_id"))
        # few files a span, and many tasks where most keys are of one
        sinks.replacing(keys.hint("rebalance", SPAN), (SPAN, "batch_id")).parquet(f"{self.root}/keys")
        mark = spark.range(1).select(F.lit(max(seen, default=None)).cast("long").alias("newest"))
        mark.write.mode("overwrite").parquet(f"{self.root}/marks/batch_id={batch_id}")
        for old in set(marks) - set(self._known(marks)):
            for folder in sinks.folders(spark, f"{self.root}/keys/{SPAN}=*/batch_id={old}"):
                sinks.remove(spark, folder)
            sinks.remove(spark, f"{self.root}/marks/batch_id={old}")


def start_pipeline(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    dead_letter_path: str | None = None,
    window_seconds: int = 0,
    metrics: bool = False,
    metrics_window_seconds: int = 60,
    delay: str | None = None,
    repeats_within: str | None = None,
    once: bool = False,
    archive_folders: tuple[str, ...] = sinks.ARCHIVE_FOLDERS,
) -> dict[str, StreamingQuery]:
    """All sinks of the pipeline. Returns the running queries by name.

    ``sinks`` writes archive, table, dead letters and panes from one parse of each micro-batch, with
    one ``ingest_ts``; every sink replaces what a failed try of the batch left. ``aggregates`` keeps
    window state and is a query of its own; ``window_seconds=0`` leaves it out, ``metrics=False`` the
    panes. Windows wait ``delay`` for late readings, and it must be given with them; what may come later
    still is kept in ``minute_agg_late`` for ``windows.correct_windows``.

    With ``repeats_within``, a message that a broker delivers again within this time, by publish
    time, is dropped before anything is written (see ``Delivered``); one that comes late for the first
    time is written like any other. The windows count a message once, too.
    """
    if window_seconds > 0 and delay is None:
        raise ValueError("windows need a delay")
    sinks.require_table(messages.sparkSession, f"{root}/readings")
    name = stream_name(checkpoint)
    to_table = table_writer(f"{root}/readings", checkpoint)
    to_panes = pane_writer(f"{root}/metrics", metrics_window_seconds, delay)
    keep_late = None
    if window_seconds > 0:
        keep_late = windows.late_rows(f"{root}/minute_agg_late", window_seconds, delay=delay)

    delivered = None
    if repeats_within is not None:
        delivered = Delivered(messages.sparkSession, f"{checkpoint}/delivered", repeats_within)

    def write_all(batch: DataFrame, batch_id: int) -> None:
        arrival = datetime.now(timezone.utc)
        seen = arrival.replace(tzinfo=None).isoformat(" ")
        fresh = batch if delivered is None else delivered.first_time(batch, batch_id)
        carried = () if delivered is None else (windows.MESSAGE, "publish_ts")
        checked = ingest.sorted_out(ingest.validate(ingest.parse(fresh), seen), seen, carried).persist()
        try:
            valid = ingest.sorted_readings(checked)
            sinks.archive_batch(valid, f"{root}/raw", name, batch_id, archive_folders)
            to_table(valid, batch_id)
            if keep_late is not None:
                keep_late(valid, batch_id)
            if dead_letter_path is not None:
                payloads = ingest.sorted_letters(checked)
                payloads.write.mode("overwrite").parquet(f"{dead_letter_path}/batch_id={batch_id}")
            if metrics:
                to_panes(valid, batch_id)
            if delivered is not None:
                delivered.remember(checked, batch_id, arrival)
        finally:
            checked.unpersist()

    writer = messages.writeStream.foreachBatch(write_all).option("checkpointLocation", f"{checkpoint}/sinks")
    started = {"sinks": _run(writer, once, "30 seconds").start()}
    if window_seconds > 0:
        started["aggregates"] = start_minute_aggregates(
            valid_readings(messages) if repeats_within is None else keyed_readings(messages),
            f"{root}/minute_agg",
            f"{checkpoint}/aggregates",
            window_seconds,
            once,
            delay=delay,
            once_each=repeats_within is not None,
        )
    return started
