"""Streaming operators, sinks and table upkeep, run to completion over the whole tables.

Each query stages its projection as files under the shared scratch folder,
streams all of it with ``availableNow`` and reads back what the sink holds. Stateful
ones let the readings arrive in several parts, in the order of their arrival times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattspark.operators import demand_response as dr
from wattspark.operators import health, rollups, voltage
from wattspark.plans.demand_queries import (
    AS_OF,
    BASE_DOUBLES,
    DAILY_DOUBLES,
    DAILY_HEALTH,
    DAYS,
    HEALTH,
    HISTORY,
    METRICS,
    baseline_cte,
)
from wattspark.plans.ingest_queries import ENRICHED, MEASURED, PAYLOADS, shown_payloads
from wattspark.plans.metric_queries import LONG, MINUTE
from wattspark.plans.projections import fleet, messages, numbered_readings, readings
from wattspark.plans.registry import query
from wattspark.plans.rollup_queries import WINDOW_DOUBLES, WINDOW_STATS
from wattspark.plans.voltage_queries import EVENT_COLUMNS, MAX_GAP, VOLTS, events_sql
from wattspark.schemas import DER_METRICS, METRICS as METRIC_SCHEMA, READINGS
from wattspark.session import scratch_dir
from wattspark.sources import sinks, streams, tables
from wattspark.streaming import pipeline, sags, windows


# The events hold a few readings per meter and day: daily archive folders fit them.
DAILY = ("pole_id", "dt")


def _staged(spark: SparkSession, df: DataFrame) -> str:
    path = scratch_dir(spark, "staged")
    df.write.parquet(path)
    return path


def _finish(*queries) -> None:
    for started in queries:
        if started is not None:
            started.awaitTermination()


def _message_stream(spark, sf_dir):
    return streams.message_stream(spark, _staged(spark, messages(spark, sf_dir)))


def _readings_stream(spark, sf_dir):
    return streams.readings_stream(spark, _staged(spark, readings(spark, sf_dir)))


# Arrival times at which a new part begins, and how late readings come at most.
PARTS = ("2024-01-09", "2024-01-16", "2024-01-23")
LATEST = "13 hours"
PARTED = (
    "parted AS (SELECT *, CASE "
    + " ".join(f"WHEN ingest_ts < TIMESTAMP '{t}' THEN {n}" for n, t in enumerate(PARTS))
    + f" ELSE {len(PARTS)} END AS part FROM readings)"
)


def _closing(rows: DataFrame) -> DataFrame:
    """A reading of no meter, dated past all others: it moves the watermark on when the input ends."""
    fixed = {
        "event_ts": F.col("last") + F.expr("INTERVAL 1 DAY"),
        "ingest_ts": F.col("last") + F.expr("INTERVAL 1 DAY"),
        "meter_id": F.lit("closing"),
        "pole_id": F.lit("closing"),
        "seq": F.lit(0),
    }
    columns = [fixed.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in READINGS]
    return rows.agg(F.max("event_ts").alias("last")).select(*columns)


def _arriving(spark, rows: DataFrame, start, closing: bool = True) -> None:
    """Run the stream that ``start`` starts to its end after each part, and after the closing reading."""
    path, at = scratch_dir(spark, "staged"), F.col("ingest_ts")
    bounds = [F.lit(t).cast("timestamp") for t in PARTS]
    parts = [at < bounds[0], *((at >= a) & (at < b) for a, b in zip(bounds, bounds[1:])), at >= bounds[-1]]
    for part in [*(rows.filter(p) for p in parts), *([_closing(rows)] if closing else [])]:
        part.write.mode("append").parquet(path)
        _finish(start(streams.readings_stream(spark, path)))


EVERYTHING = (
    "SELECT event_ts, ingest_ts, meter_id, pole_id, seq, voltage_v, current_a, power_kw, reactive_kvar, freq_hz, "
    "array_to_string(quality_flags, ',') AS quality_flags, network_profile FROM readings"
)
MEASURES = "voltage_v current_a power_kw reactive_kvar freq_hz"
LANDED = ENRICHED.replace("TIMESTAMP '2024-01-31' AS ingest_ts, ", "")


@query("s01_message_stream_to_readings", LANDED, MEASURED)
def message_stream(spark, sf_dir):
    valid = pipeline.valid_readings(_message_stream(spark, sf_dir))
    out = scratch_dir(spark, "out")
    _finish(
        valid.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_dir(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    return tables.read_readings(spark, out).drop("ingest_ts", "event_date")


@query(
    "s06_device_topics",
    "SELECT 'DER/' || device_type AS topic, device_type, count(*) AS messages, sum(power_output) AS power_output "
    "FROM fleet GROUP BY ALL",
    "power_output",
)
def device_topics(spark, sf_dir):
    root = scratch_dir(spark, "topics")
    rows = fleet(spark, sf_dir).drop("seq")
    for kind in DER_METRICS:
        rows.filter(F.col("device_type") == kind).write.json(f"{root}/DER/{kind}")
    out = scratch_dir(spark, "out")
    _finish(
        streams.der_stream(spark, root)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_dir(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    landed = spark.read.schema("topic STRING, device_type STRING, power_output DOUBLE").parquet(out)
    return landed.groupBy("topic", "device_type").agg(
        F.count(F.lit(1)).alias("messages"), F.sum("power_output").alias("power_output")
    )


@query(
    "k01_s08_archive_and_replay",
    EVERYTHING,
    MEASURES,
)
def archive_and_replay(spark, sf_dir):
    out = scratch_dir(spark, "raw")
    _finish(
        pipeline.start_archive(
            _readings_stream(spark, sf_dir),
            out,
            scratch_dir(spark, "checkpoint"),
            once=True,
            folders=DAILY,
        )
    )
    return tables.read_archive(spark, out)


@query("k02_readings_append", EVERYTHING, MEASURES)
def readings_append(spark, sf_dir):
    """Half of the readings are there before the stream appends the other half, over several files."""
    rows, path = readings(spark, sf_dir), scratch_dir(spark, "table")
    there = F.col("event_ts") < F.lit("2024-01-16").cast("timestamp")
    sinks.write_clustered(rows.filter(there), path)
    stream = streams.readings_stream(spark, _staged(spark, rows.filter(~there)))
    _finish(pipeline.start_table(stream, path, scratch_dir(spark, "checkpoint"), once=True))
    return tables.read_readings(spark, path).drop("event_date")


@query("a01_k03_window_stats_stream", WINDOW_STATS, WINDOW_DOUBLES)
def window_stats_stream(spark, sf_dir):
    path, checkpoint = scratch_dir(spark, "minute_agg"), scratch_dir(spark, "checkpoint")
    _arriving(
        spark,
        readings(spark, sf_dir),
        lambda rows: pipeline.start_minute_aggregates(rows, path, checkpoint, once=True, delay=LATEST),
    )
    return tables.read_table(spark, path)


SERIES = (
    "SELECT metric, pole_id, end_time, value, CASE WHEN metric IN ('voltage_sag_count', 'active_meter_count') "
    "THEN 'int64' ELSE 'double' END AS value_type FROM series"
)


def _shown(series: DataFrame, *more: str) -> DataFrame:
    return series.select(
        "metric", F.col("labels")["pole_id"].alias("pole_id"), "end_time", "value", "value_type", *more
    )


@query("st01_gauges_of_closed_windows", SERIES, "value", (MINUTE, LONG))
def gauges_of_closed_windows(spark, sf_dir):
    path, checkpoint = scratch_dir(spark, "metrics"), scratch_dir(spark, "checkpoint")
    _arriving(
        spark,
        readings(spark, sf_dir),
        lambda rows: pipeline.start_gauges(rows, path, checkpoint, once=True, delay=LATEST),
    )
    return _shown(spark.read.schema(METRIC_SCHEMA).parquet(path))


PANES = MINUTE.replace("SELECT pole_id", "SELECT part, pole_id").replace("FROM readings", "FROM parted")


# What the watermark was before and after each part, with an hour's delay.
MARKS = (
    "marks AS (SELECT part, max(max(event_ts)) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
    "- INTERVAL 1 HOUR AS before, max(max(event_ts)) OVER (ORDER BY part) - INTERVAL 1 HOUR AS after "
    "FROM parted GROUP BY part)"
)


@query(
    "st02_k05_gauge_panes",
    SERIES.replace(
        "FROM series",
        ", CASE WHEN end_time <= before THEN 'LATE' WHEN end_time <= after THEN 'ON_TIME' ELSE 'EARLY' END AS pane "
        "FROM series JOIN marks USING (part)",
    ),
    "value",
    (PARTED, PANES, LONG.replace("SELECT pole_id", "SELECT part, pole_id"), MARKS),
)
def gauge_panes(spark, sf_dir):
    """Panes of several parts by kind: before, when and after the watermark closes their window."""
    path, checkpoint = scratch_dir(spark, "metrics"), scratch_dir(spark, "checkpoint")
    _arriving(
        spark,
        readings(spark, sf_dir),
        lambda rows: pipeline.start_gauge_panes(rows, path, checkpoint, once=True, delay="1 hour"),
        closing=False,
    )
    return _shown(spark.read.schema(f"{METRIC_SCHEMA.toDDL()}, pane STRING").parquet(path), "pane")


@query(
    "st03_discarding_panes",
    SERIES.replace("SELECT metric", "SELECT CAST(part AS BIGINT) AS pane, metric"),
    "value",
    (PARTED, PANES, LONG.replace("SELECT pole_id", "SELECT part, pole_id")),
)
def discarding_panes(spark, sf_dir):
    """A window whose readings come in several parts has a pane of each, with that part's readings only."""
    path, checkpoint = scratch_dir(spark, "metrics"), scratch_dir(spark, "checkpoint")
    _arriving(
        spark,
        readings(spark, sf_dir),
        lambda rows: pipeline.start_gauge_panes(rows, path, checkpoint, once=True),
        closing=False,
    )
    panes = spark.read.schema(f"{METRIC_SCHEMA.toDDL()}, batch_id BIGINT").parquet(path)
    return panes.select(
        F.col("batch_id").alias("pane"),
        "metric",
        F.col("labels")["pole_id"].alias("pole_id"),
        "end_time",
        "value",
        "value_type",
    )


@query(
    "st07_flush_each_minute",
    SERIES.replace("SELECT metric", "SELECT CAST(part AS BIGINT) AS pane, metric"),
    "value",
    (
        f"parted AS (SELECT *, CASE WHEN ingest_ts < TIMESTAMP '{PARTS[0]}' THEN 0 ELSE 1 END AS part FROM readings)",
        PANES,
        LONG.replace("SELECT pole_id", "SELECT part, pole_id"),
    ),
)
def flush_each_minute(spark, sf_dir):
    """A running stream that flushes every 60 seconds: the first flush has what is there, what comes before
    the next one stays buffered, and the flush at the end has it."""
    path, checkpoint, staged = (scratch_dir(spark, n) for n in ("metrics", "checkpoint", "staged"))
    rows, bound = readings(spark, sf_dir), F.lit(PARTS[0]).cast("timestamp")
    rows.filter(F.col("ingest_ts") < bound).write.parquet(staged)
    source = streams.readings_stream(spark, staged)
    running = pipeline.start_gauge_panes(source, path, checkpoint, flush_seconds=60)
    while running.isActive and not running.recentProgress:
        running.awaitTermination(1)
    rows.filter(F.col("ingest_ts") >= bound).write.mode("append").parquet(staged)
    running.stop()
    _finish(pipeline.start_gauge_panes(source, path, checkpoint, once=True))
    panes = spark.read.schema(f"{METRIC_SCHEMA.toDDL()}, batch_id BIGINT").parquet(path)
    return panes.select(
        F.col("batch_id").alias("pane"),
        "metric",
        F.col("labels")["pole_id"].alias("pole_id"),
        "end_time",
        "value",
        "value_type",
    )


@query("k04_dead_letters", PAYLOADS)
def dead_letters(spark, sf_dir):
    path = scratch_dir(spark, "dead_letters")
    payloads = pipeline.dead_letters(_message_stream(spark, sf_dir))
    _finish(
        pipeline.start_dead_letters(payloads, path, scratch_dir(spark, "checkpoint"), once=True)
    )
    return shown_payloads(spark.read.schema("value BINARY").parquet(path))


@query("s03_k06_baseline_table", "SELECT * FROM baseline", BASE_DOUBLES, (HISTORY, baseline_cte()))
def baseline_table(spark, sf_dir):
    path = scratch_dir(spark, "baseline")
    rows = dr.baseline(readings(spark, sf_dir), AS_OF, DAYS, f"{AS_OF} 00:00:00")
    sinks.replace_table(rows, path)
    return tables.read_baseline(spark, path)


@query("k07_daily_health_view", DAILY_HEALTH, DAILY_DOUBLES, (METRICS, HEALTH))
def daily_health_view(spark, sf_dir):
    hourly = health.hourly_health(readings(spark, sf_dir))
    sinks.replace_view(health.daily_health(hourly), "pole_health_daily")
    return spark.sql("SELECT * FROM pole_health_daily")


@query(
    "k08_clustered_round_trip",
    EVERYTHING.replace("SELECT event_ts", "SELECT CAST(event_ts AS DATE) AS event_date, event_ts"),
    MEASURES,
)
def clustered_round_trip(spark, sf_dir):
    path = scratch_dir(spark, "readings")
    sinks.write_clustered(readings(spark, sf_dir), path)
    return tables.read_readings(spark, path)


@query(
    "k09_retention",
    EVERYTHING + " WHERE event_ts >= TIMESTAMP '2024-01-11'",
    MEASURES,
)
def retention(spark, sf_dir):
    """Dates of a streamed table expire; the rest is read from the table."""
    path, stream = scratch_dir(spark, "readings"), _readings_stream(spark, sf_dir)
    _finish(pipeline.start_table(stream, path, scratch_dir(spark, "checkpoint"), must_exist=False, once=True))
    sinks.drop_expired(spark, path, "2024-01-31", 20)
    return sinks.retained(tables.read_readings(spark, path), "2024-01-31", 20).drop("event_date")


@query(
    "k09_archive_retention",
    EVERYTHING.replace(" seq,", " event_id AS seq,").replace("FROM readings", "FROM (SELECT * REPLACE (CASE WHEN event_id % 50 <> 7 THEN event_ts END AS event_ts) FROM readings)")
    + " WHERE event_ts IS NULL OR event_ts >= TIMESTAMP '2024-01-11'",
    MEASURES,
)
def archive_retention(spark, sf_dir):
    """Days of the archive expire below their poles; rows without a time stay until their batch is old."""
    path, timed = scratch_dir(spark, "raw"), F.when(F.col("seq") % 50 != 7, F.col("event_ts"))
    sinks.write_archive(numbered_readings(spark, sf_dir).withColumn("event_ts", timed), path, DAILY)
    sinks.drop_expired(spark, path, "2024-01-31", 20, "dt")
    return tables.read_archive(spark, path)


@query("k08_compacted_table", EVERYTHING, MEASURES)
def compacted_table(spark, sf_dir):
    """A table that a stream filled in parts, some of its dates rewritten afterwards."""
    path, checkpoint = scratch_dir(spark, "readings"), scratch_dir(spark, "checkpoint")
    _arriving(
        spark,
        readings(spark, sf_dir),
        lambda rows: pipeline.start_table(rows, path, checkpoint, must_exist=False, once=True),
        closing=False,
    )
    sinks.compact(spark, path, ["2024-01-08", "2024-01-09", "2024-01-16"])
    return tables.read_readings(spark, path).drop("event_date")


@query(
    "k10_voltage_event_table",
    "SELECT 'sag' AS event_type, * REPLACE (lower(severity) AS severity) FROM ("
    + events_sql("voltage_v < 220", 5)
    + ") UNION ALL SELECT 'swell', * REPLACE ('minor' AS severity) FROM ("
    + events_sql("voltage_v > 260", 5, "'MINOR'")
    + ")",
    VOLTS,
)
def voltage_event_table(spark, sf_dir):
    """Both kinds of events are merged into the table, and the sags a second time, which changes nothing."""
    path = scratch_dir(spark, "voltage_events")
    rows, seen = readings(spark, sf_dir), "2024-01-31 00:00:00"
    sags_found = voltage.event_rows(voltage.sag_events(rows), "sag", seen)
    swells_found = voltage.event_rows(voltage.swell_events(rows), "swell", seen)
    for found in (sags_found, swells_found, sags_found):
        sinks.merge_rows(found, path)
    return spark.read.parquet(path).select("event_type", *EVENT_COLUMNS)


@query(
    "st10_repeats_dropped_stream",
    "SELECT meter_id, event_id AS seq, event_ts, voltage_v FROM readings",
    "voltage_v",
)
def repeats_dropped_stream(spark, sf_dir):
    """Every third reading comes again an hour later, some of them in the next part; each stays once."""
    rows = numbered_readings(spark, sf_dir)
    again = rows.filter(F.col("seq") % 3 == 0)
    again = again.withColumn("ingest_ts", F.col("ingest_ts") + F.expr("INTERVAL 1 HOUR"))
    out, checkpoint = scratch_dir(spark, "out"), scratch_dir(spark, "checkpoint")

    def start(stream):
        writer = windows.drop_repeats(stream, LATEST).writeStream.format("parquet").option("path", out)
        return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    _arriving(spark, rows.unionByName(again), start, closing=False)
    return spark.read.schema(READINGS).parquet(out).select("meter_id", "seq", "event_ts", "voltage_v")


def _sags(spark, sf_dir, delay_seconds: int, max_gap_seconds: int | None = None) -> sags.SagState:
    state = sags.SagState(scratch_dir(spark, "state"), delay_seconds, max_gap_seconds=max_gap_seconds)
    checkpoint = scratch_dir(spark, "checkpoint")
    _arriving(
        spark,
        readings(spark, sf_dir),
        lambda rows: sags.start_sag_events(rows, state, checkpoint, once=True),
    )
    return state


@query("st11_sag_events_stream", events_sql("voltage_v < 220", 5), VOLTS)
def sag_events_stream(spark, sf_dir):
    """Runs carry over between parts; readings that overlap the next part wait for it."""
    state = _sags(spark, sf_dir, 13 * 3600)
    return state.events(spark).unionByName(state.open_events(spark)).select(*EVENT_COLUMNS)


@query(
    "st04_late_readings",
    "SELECT meter_id, event_ts, seq, voltage_v FROM parted JOIN (SELECT part, max(max(event_ts)) OVER (ORDER BY part "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM parted GROUP BY part) USING (part) "
    "WHERE event_ts <= seen - INTERVAL 1 HOUR",
    "voltage_v",
    (PARTED,),
)
def late_readings(spark, sf_dir):
    """With a watermark of an hour, readings that come half a day late are kept aside."""
    return _sags(spark, sf_dir, 3600).late(spark).select("meter_id", "event_ts", "seq", "voltage_v")


@query("st11_sag_events_split_by_gaps", events_sql("voltage_v < 220", 5, max_gap=MAX_GAP), VOLTS)
def sag_events_stream_split_by_gaps(spark, sf_dir):
    """As the batch form, also where the long time without readings is between two parts."""
    state = _sags(spark, sf_dir, 13 * 3600, MAX_GAP)
    return state.events(spark).unionByName(state.open_events(spark)).select(*EVENT_COLUMNS)


@query("st04_corrected_windows", WINDOW_STATS, WINDOW_DOUBLES)
def corrected_windows(spark, sf_dir):
    """With a watermark of an hour the windows drop what comes half a day late; corrections bring it back."""
    root, checkpoint = scratch_dir(spark, "lake"), scratch_dir(spark, "checkpoint")

    def start(rows):
        writers = {
            "table": pipeline.table_writer(f"{root}/readings", checkpoint),
            "late": windows.late_rows(f"{root}/late", delay="1 hour"),
        }
        _finish(pipeline.start_fan_out(rows, writers, f"{checkpoint}/sinks", once=True))
        return pipeline.start_minute_aggregates(rows, f"{root}/minute_agg", f"{checkpoint}/aggregates", once=True, delay="1 hour")

    _arriving(spark, readings(spark, sf_dir), start)
    windows.correct_windows(spark, f"{root}/late", f"{root}/readings", f"{root}/corrections")
    aggregates, corrections = (tables.read_table(spark, f"{root}/{name}") for name in ("minute_agg", "corrections"))
    return windows.corrected(aggregates, corrections)


LETTERS = (
    f"letters AS (SELECT error_type, event_ts AS letter_event_ts, meter_id AS letter_meter_id, seq AS letter_seq FROM ({PAYLOADS}))"
)
LANDED_CTE = f"landed AS ({LANDED})"


def _labelled(**sinks_rows: DataFrame) -> DataFrame:
    """Rows of several sinks under one another; columns that a sink does not have are null."""
    parts = [rows.select(F.lit(name).alias("sink"), "*") for name, rows in sinks_rows.items()]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part, allowMissingColumns=True)
    return found


def _letters(spark, path: str) -> DataFrame:
    shown = shown_payloads(spark.read.schema("value BINARY").parquet(path))
    return shown.toDF("error_type", "letter_event_ts", "letter_meter_id", "letter_seq")


def _deliveries(rows: DataFrame) -> DataFrame:
    """The messages as they are delivered, with their ``part``: staged by parts in one pass over ``rows``,
    a row for each delivery, so that no part computes all messages anew."""
    at, bounds = F.col("publish_ts"), [F.lit(t).cast("timestamp") for t in PARTS]
    late = F.pmod(F.crc32("data"), F.lit(11)).eqNullSafe(1)
    times = F.when(F.pmod(F.crc32("data"), F.lit(5)) == 0, 2).otherwise(1)
    found = []
    for n, (before, since, until) in enumerate(zip([None, None, *bounds], [None, *bounds], [*bounds, None])):
        due = at.isNotNull() if until is None else (at < until) & ~late
        if since is not None:
            due = due & (at >= since - F.expr("INTERVAL 1 HOUR"))
            missed = late & (at < since)
            due = due | (missed if before is None else missed & (at >= before))
        found.append(F.when(due, F.array_repeat(F.lit(n), times)).otherwise(F.array().cast("array<int>")))
    dealt = rows.select("*", F.explode(F.concat(*found)).alias("part"))
    path = scratch_dir(rows.sparkSession, "deliveries")
    dealt.write.partitionBy("part").parquet(path)
    return rows.sparkSession.read.schema(dealt.schema).parquet(path)


@query(
    "st09_redelivered_messages",
    "SELECT 'raw' AS sink, * FROM landed UNION ALL BY NAME SELECT 'readings' AS sink, * FROM landed "
    "UNION ALL BY NAME SELECT 'dead_letters' AS sink, * FROM letters",
    MEASURED,
    (LANDED_CTE, LETTERS),
)
def redelivered_messages(spark, sf_dir):
    """A fifth of the messages comes twice, and those of a part's last hour again with the next part.
    An eleventh comes for the first time with the part after its own, days late.

    All rows of archive, table and dead letters, on every column but the arrival time.
    """
    parts, source = _deliveries(messages(spark, sf_dir)), scratch_dir(spark, "staged")
    root, checkpoint = scratch_dir(spark, "lake"), scratch_dir(spark, "checkpoint")
    sinks.write_clustered(readings(spark, sf_dir).limit(0), f"{root}/readings")
    for part in range(len(PARTS) + 1):
        parts.filter(F.col("part") == part).drop("part").write.mode("append").parquet(source)
        stream = streams.message_stream(spark, source)
        started = pipeline.start_pipeline(
            stream,
            root,
            checkpoint,
            dead_letter_path=f"{root}/dead_letters",
            repeats_within="2 hours",
            once=True,
            archive_folders=("pole_id",),
        )
        _finish(*started.values())
    return _labelled(
        raw=tables.read_archive(spark, f"{root}/raw").drop("ingest_ts"),
        readings=tables.read_readings(spark, f"{root}/readings").drop("ingest_ts", "event_date"),
        dead_letters=_letters(spark, f"{root}/dead_letters"),
    )


@query(
    "st08_fan_out",
    WINDOW_STATS.replace("count(*) AS reading_count", "count(*) AS reading_count, count(*) AS passed"),
    WINDOW_DOUBLES,
)
def fan_out(spark, sf_dir):
    root = scratch_dir(spark, "fan_out")

    def passed(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/passed/batch_id={batch_id}")

    def stats(batch, batch_id):
        rollups.pole_window_stats(batch).write.mode("overwrite").parquet(
            f"{root}/stats/batch_id={batch_id}"
        )

    _finish(
        pipeline.start_fan_out(
            _readings_stream(spark, sf_dir),
            {"passed": passed, "stats": stats},
            scratch_dir(spark, "checkpoint"),
            once=True,
        )
    )
    window = F.date_trunc("minute", "event_ts").alias("window_start")
    rows = spark.read.schema(READINGS).parquet(f"{root}/passed").groupBy("pole_id", window)
    counts = rows.agg(F.count(F.lit(1)).alias("passed"))
    return spark.read.parquet(f"{root}/stats").drop("batch_id").join(counts, ["pole_id", "window_start"])


DAY_BUCKET = "time_bucket(INTERVAL 1 DAY, event_ts)"


@query(
    "st12_pipeline",
    "SELECT 'raw' AS sink, * FROM landed UNION ALL BY NAME SELECT 'readings' AS sink, * FROM landed "
    "UNION ALL BY NAME SELECT 'dead_letters' AS sink, * FROM letters "
    "UNION ALL BY NAME SELECT 'minute_agg' AS sink, * FROM daily "
    "WHERE window_start + INTERVAL 1 DAY <= (SELECT max(event_ts) FROM landed) "
    f"UNION ALL BY NAME SELECT 'metrics' AS sink, *, CASE WHEN end_time <= (SELECT max(event_ts) FROM landed) "
    f"THEN 'ON_TIME' ELSE 'EARLY' END AS pane FROM ({SERIES})",
    f"{MEASURED} {WINDOW_DOUBLES} value",
    (
        LANDED_CTE,
        LETTERS,
        f"daily AS ({WINDOW_STATS.replace('FROM readings', 'FROM landed')})".replace("date_trunc('minute', event_ts)", DAY_BUCKET),
        MINUTE.replace("date_trunc('minute', event_ts) + INTERVAL 1 MINUTE", f"{DAY_BUCKET} + INTERVAL 1 DAY").replace("FROM readings", "FROM landed"),
        LONG,
    ),
)
def whole_pipeline(spark, sf_dir):
    """Every sink of the pipeline over one message stream, with daily windows."""
    root, stream = scratch_dir(spark, "lake"), _message_stream(spark, sf_dir)
    sinks.write_clustered(readings(spark, sf_dir).limit(0), f"{root}/readings")
    started = pipeline.start_pipeline(
        stream,
        root,
        scratch_dir(spark, "checkpoint"),
        dead_letter_path=f"{root}/dead_letters",
        window_seconds=86_400,
        metrics=True,
        metrics_window_seconds=86_400,
        delay="0 seconds",
        once=True,
        archive_folders=DAILY,
    )
    _finish(*started.values())
    return _labelled(
        raw=tables.read_archive(spark, f"{root}/raw").drop("ingest_ts"),
        readings=tables.read_readings(spark, f"{root}/readings").drop("ingest_ts", "event_date"),
        dead_letters=_letters(spark, f"{root}/dead_letters"),
        minute_agg=tables.read_table(spark, f"{root}/minute_agg"),
        metrics=_shown(spark.read.schema(f"{METRIC_SCHEMA.toDDL()}, pane STRING").parquet(f"{root}/metrics"), "pane"),
    )
