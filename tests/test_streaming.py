import json
import os
import random
import time
import zlib
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.build import START, reading, readings, rows
from wattspark.operators import gauges, ingest, rollups, voltage
from wattspark.plans import stream_queries
from wattspark.schemas import ENVELOPE, MINUTE_AGG, READINGS
from wattspark.sources import sinks, streams, tables
from wattspark.streaming import pipeline, sags, windows


def land(df, folder):
    """Add one file to a stream folder, later than the files before it."""
    df.coalesce(1).write.mode("append").parquet(str(folder))
    time.sleep(0.05)


def run(writer, out, checkpoint):
    started = (
        writer.format("parquet")
        .option("path", str(out))
        .option("checkpointLocation", str(checkpoint))
        .trigger(availableNow=True)
        .start()
    )
    started.awaitTermination()
    return started


def sample(seed=1, n=240, step=10):
    rnd = random.Random(seed)
    return [
        reading(i * step, rnd.choice([199.0, 212.0, 235.0, 261.0]), f"m{i % 4}", f"pole_{i % 2}", seq=i)
        for i in range(n)
    ]


def test_window_stats_equal_batch_over_several_batches(spark, tmp_path):
    data = sample()
    for part in range(4):
        land(readings(spark, *data[part * 60 : part * 60 + 60]), tmp_path / "in")
    stream = streams.readings_stream(spark, str(tmp_path / "in"), 1)
    started = run(windows.pole_window_stats(stream, 60, delay="0 seconds").writeStream, tmp_path / "out", tmp_path / "cp")
    assert len(started.recentProgress) >= 4
    end = max(r[0] for r in data)
    batch = rollups.pole_window_stats(readings(spark, *data), 60).filter(
        F.col("window_start") + F.expr("INTERVAL 1 MINUTE") <= F.lit(end)
    )
    got = spark.read.parquet(str(tmp_path / "out"))
    assert [f.name for f in got.schema] == MINUTE_AGG.names
    shown = lambda df: [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows(df)]
    assert shown(got.select(*MINUTE_AGG.names)) == shown(batch)


def test_late_rows_are_dropped_after_two_advances(spark, tmp_path):
    for second in (1, 300, 600, 2):
        land(readings(spark, reading(second)), tmp_path / "in")
    stream = streams.readings_stream(spark, str(tmp_path / "in"), 1)
    run(windows.pole_window_stats(stream, 60, delay="0 seconds").writeStream, tmp_path / "out", tmp_path / "cp")
    first = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").first()
    assert first.reading_count == 1


def test_gauges_of_closed_windows_equal_batch(spark, tmp_path):
    data = sample(2, 60)
    land(readings(spark, *data), tmp_path / "in")
    stream = streams.readings_stream(spark, str(tmp_path / "in"))
    started = pipeline.start_gauges(stream, str(tmp_path / "out"), str(tmp_path / "cp"), once=True, delay="0 seconds")
    started.awaitTermination()
    end = max(r[0] for r in data)
    batch = gauges.to_series(gauges.pole_gauges(readings(spark, *data))).filter(F.col("end_time") <= F.lit(end))
    cols = ("metric", "end_time", "value", "value_type")
    got = spark.read.parquet(str(tmp_path / "out"))
    assert rows(got, *cols) == rows(batch, *cols) and got.count() > 0


def test_panes_hold_only_their_batch_and_survive_a_retry(spark, tmp_path):
    write = pipeline.pane_writer(str(tmp_path / "m"), 60)
    write(readings(spark, reading(0), reading(1)), 0)
    write(readings(spark, reading(2)), 1)
    write(readings(spark, reading(2)), 1)
    got = spark.read.parquet(str(tmp_path / "m")).filter("metric = 'power_total_kw'")
    assert rows(got, "batch_id", "value") == [(0, 2.0), (1, 1.0)]


def events_of(spark, state, last):
    both = state.events(spark).unionByName(state.open_events(spark, last))
    return rows(both, "meter_id", "pole_id", "event_start", "reading_count", "min_voltage_v", "severity")


@pytest.mark.parametrize("delay, shuffled", [(0, False), (200, True)])
def test_sag_stream_equals_batch(spark, tmp_path, delay, shuffled):
    data = sample(5, 200)
    if shuffled:  # neighbours swap places, well within the delay
        for i in range(0, len(data) - 8, 8):
            data[i], data[i + 7] = data[i + 7], data[i]
    state = sags.SagState(str(tmp_path / "state"), delay_seconds=delay, slice_seconds=60)
    for n in range(5):
        state.step(readings(spark, *data[n * 40 : n * 40 + 40]), n)
    last = 4
    if delay:  # one far reading pushes the watermark past everything
        state.step(readings(spark, reading(10**6, 240.0, "other")), 5)
        state.step(readings(spark, reading(2 * 10**6, 240.0, "other")), 6)
        last = 6
    batch = voltage.sag_events(readings(spark, *data))
    want = rows(batch, "meter_id", "pole_id", "event_start", "reading_count", "min_voltage_v", "severity")
    assert events_of(spark, state, last) == want


def test_sag_step_can_be_repeated(spark, tmp_path):
    data = sample(6, 80)
    state = sags.SagState(str(tmp_path / "state"), delay_seconds=0)
    state.step(readings(spark, *data[:40]), 0)
    state.step(readings(spark, *data[40:]), 1)
    once = events_of(spark, state, 1)
    state.step(readings(spark, *data[40:]), 1)
    assert events_of(spark, state, 1) == once


def test_sag_stream_drops_late_rows_and_keeps_open_runs(spark, tmp_path):
    state = sags.SagState(str(tmp_path / "state"), delay_seconds=0)
    state.step(readings(spark, reading(0, 210.0), reading(10, 211.0)), 0)
    assert state.events(spark).count() == 0
    state.step(readings(spark, reading(5, 240.0), reading(20, 212.0)), 1)  # the first is late
    state.step(readings(spark, reading(30, 240.0)), 2)
    assert rows(state.events(spark), "reading_count", "duration_seconds") == [(3, 21)]
    assert rows(state.late(spark), "batch_id", "voltage_v") == [(1, 240.0)] and state.last_batch(spark) == 2


def test_pipeline_drops_redelivered_messages(spark, tmp_path):
    root = str(tmp_path / "lake")
    sinks.write_clustered(readings(spark, reading()).limit(0), f"{root}/readings")
    for n in (10, 20):  # the first ten come again with the next ten
        messages(spark, tmp_path / "in", n)
        started = pipeline.start_pipeline(
            streams.message_stream(spark, str(tmp_path / "in")), root, str(tmp_path / "cp"),
            window_seconds=10, delay="0 seconds", repeats_within="1 hour", once=True,
        )
        for q in started.values():
            q.awaitTermination()
    assert tables.read_readings(spark, f"{root}/readings").count() == 16
    assert spark.read.parquet(f"{root}/minute_agg").agg(F.sum("reading_count")).first()[0] == 8
    with pytest.raises(ValueError):
        pipeline.start_pipeline(streams.message_stream(spark, str(tmp_path / "in")), root, "x", window_seconds=10)


def test_messages_that_come_late_for_the_first_time_are_written(spark, tmp_path):
    root, sent = str(tmp_path / "lake"), datetime(2025, 12, 26, 12)
    sinks.write_clustered(readings(spark, reading()).limit(0), f"{root}/readings")
    body = lambda i: json.dumps(
        {"event_ts": "2025-12-26T12:00:00Z", "meter_id": "m1", "pole_id": "p", "seq": i, "voltage_v": 240.0,
         "current_a": 1.0, "power_kw": 1.0}
    ).encode()
    row = lambda i, hours: (bytearray(body(i)), {}, sent + timedelta(hours=hours))
    # the third batch: late for the first time (valid, broken, without a body) and again, and a known one again
    empty = [(None, {"k": str(i)}, sent) for i in range(2)]
    late = [row(3, 1), row(3, 1), (bytearray(b"{"), {}, sent), *empty]
    batches = [[row(1, 0)], [row(2, 10)], [*late, row(2, 10)], [row(3, 1), row(2, 10), row(4, 10.5)], [row(4, 10.5)]]
    for batch in batches:
        land(spark.createDataFrame(batch, ENVELOPE), tmp_path / "in")
        started = pipeline.start_pipeline(
            streams.message_stream(spark, str(tmp_path / "in")), root, str(tmp_path / "cp"),
            dead_letter_path=f"{root}/dlq", repeats_within="1 hour", once=True,
        )
        started["sinks"].awaitTermination()
    assert rows(tables.read_readings(spark, f"{root}/readings"), "seq") == [(1,), (2,), (3,), (4,)]
    assert rows(tables.read_archive(spark, f"{root}/raw"), "seq") == [(1,), (2,), (3,), (4,)]
    assert spark.read.parquet(f"{root}/dlq").count() == 3
    # what is out of reach is forgotten
    assert not list((tmp_path / "cp" / "delivered" / "keys").glob("*/batch_id=0"))
    with pytest.raises(Exception):
        pipeline.Delivered(spark, str(tmp_path / "d"), "some time")


def test_windows_count_readings_without_or_with_restarted_numbers(spark, tmp_path):
    root, sent = str(tmp_path / "lake"), datetime(2025, 12, 26, 12)
    sinks.write_clustered(readings(spark, reading()).limit(0), f"{root}/readings")

    def row(second, seq):
        body = {"event_ts": f"2025-12-26T12:00:{second:02d}Z", "meter_id": "m1", "pole_id": "p", "voltage_v": 240.0}
        body |= {"current_a": 1.0, "power_kw": 1.0} | ({} if seq is None else {"seq": seq})
        return bytearray(json.dumps(body).encode()), {}, sent + timedelta(seconds=second)

    first = [row(i, None) for i in range(4)] + [row(i, i) for i in (4, 5)]
    second = [row(i, None) for i in range(2, 8)] + [row(6, 4), row(59, 9)]  # two come again, a number restarts
    for batch in (first, second):
        land(spark.createDataFrame(batch, ENVELOPE), tmp_path / "in")
        started = pipeline.start_pipeline(
            streams.message_stream(spark, str(tmp_path / "in")), root, str(tmp_path / "cp"),
            window_seconds=10, delay="10 seconds", repeats_within="1 hour", once=True,
        )
        for q in started.values():
            q.awaitTermination()
    stored = tables.read_readings(spark, f"{root}/readings").filter("event_ts < '2025-12-26 12:00:10'").count()
    assert stored == 11
    assert spark.read.parquet(f"{root}/minute_agg").agg(F.sum("reading_count")).first()[0] == stored


def test_readings_without_a_number_are_no_repeats(spark, tmp_path):
    bare = [reading(i, seq=None)[:4] + (None,) + reading(i)[5:] for i in (1, 2, 2)]
    numbered = [reading(1, seq=7), reading(1, seq=7), reading(3, seq=7)]
    for part in (bare + numbered, bare + numbered[:1]):
        land(readings(spark, *part), tmp_path / "in")
    stream = streams.readings_stream(spark, str(tmp_path / "in"), 1)
    run(windows.drop_repeats(stream, "10 minutes").writeStream, tmp_path / "out", tmp_path / "cp")
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.filter("seq IS NULL").count() == 6 and got.filter("seq = 7").count() == 2
    assert got.columns == readings(spark, *numbered).columns


def test_a_repeated_batch_sees_the_messages_its_first_try_saw(spark, tmp_path):
    sent = datetime(2025, 12, 26, 12)
    batch = lambda *ids: spark.createDataFrame([(bytearray(b"%d" % i), {}, sent) for i in ids], ENVELOPE)
    delivered = pipeline.Delivered(spark, str(tmp_path / "d"), "1 hour")
    for n, ids, want in ((0, (1, 2, 2), 2), (1, (2, 3), 1), (1, (2, 3), 1), (2, (1, 2, 3, 4), 1)):
        fresh = delivered.first_time(batch(*ids), n).persist()
        assert fresh.count() == want
        delivered.remember(fresh, n)
        fresh.unpersist()


def messages(spark, folder, n=20):
    body = lambda i: json.dumps(
        {
            "event_ts": f"2025-12-26T12:00:{i:02d}Z", "meter_id": f"m{i % 3}", "pole_id": "pole_A",
            "seq": i, "voltage_v": 240.0, "current_a": 1.0, "power_kw": "bad" if i % 5 == 0 else 1.0,
        }
    ).encode()
    sent = datetime(2025, 12, 26, 12)
    data = [(bytearray(body(i)), {"network_profile": "5g"}, sent + timedelta(seconds=i)) for i in range(n)]
    land(spark.createDataFrame(data, ENVELOPE), folder)


def test_pipeline_writes_every_sink(spark, tmp_path):
    messages(spark, tmp_path / "in")
    root = str(tmp_path / "lake")
    sinks.write_clustered(readings(spark, reading()).limit(0), f"{root}/readings")
    started = pipeline.start_pipeline(
        streams.message_stream(spark, str(tmp_path / "in")), root, str(tmp_path / "cp"),
        dead_letter_path=f"{root}/dlq", window_seconds=10, metrics=True, delay="0 seconds", once=True,
    )
    for q in started.values():
        q.awaitTermination()
    assert set(started) == {"sinks", "aggregates"}
    stored = rows(tables.read_readings(spark, f"{root}/readings").drop("event_date"))
    assert stored == rows(tables.read_archive(spark, f"{root}/raw"))  # ingest_ts included
    assert tables.read_readings(spark, f"{root}/readings").count() == 16
    assert tables.read_archive(spark, f"{root}/raw").count() == 16
    assert spark.read.parquet(f"{root}/dlq").count() == 4
    assert spark.read.parquet(f"{root}/minute_agg").agg(F.sum("reading_count")).first()[0] == 8
    assert os.path.isdir(f"{root}/raw/pole_id=pole_A/dt=2025-12-26/hr=12/min=00")


def test_dead_letters_are_optional_and_the_table_is_not(spark, tmp_path):
    messages(spark, tmp_path / "in")
    stream = streams.message_stream(spark, str(tmp_path / "in"))
    assert pipeline.start_dead_letters(pipeline.dead_letters(stream), None, str(tmp_path / "a")) is None
    with pytest.raises(FileNotFoundError):
        pipeline.start_table(pipeline.valid_readings(stream), str(tmp_path / "none"), str(tmp_path / "b"))


def test_restart_reads_nothing_twice(spark, tmp_path):
    messages(spark, tmp_path / "in")
    sinks.write_clustered(readings(spark, reading()).limit(0), str(tmp_path / "t"))
    for _ in range(2):
        valid = pipeline.valid_readings(streams.message_stream(spark, str(tmp_path / "in")))
        pipeline.start_table(valid, str(tmp_path / "t"), str(tmp_path / "cp"), once=True).awaitTermination()
    assert tables.read_readings(spark, str(tmp_path / "t")).count() == 16


def test_appends_keep_what_is_there_and_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_clustered(readings(spark, *[reading(i, seq=i) for i in range(50)]), path)
    more = readings(spark, *[reading(i, seq=i) for i in range(50, 80)])
    for _ in range(2):
        sinks.append_batch(more, path, "stream", 7)
    got = tables.read_readings(spark, path)
    assert sorted(r.seq for r in got.collect()) == list(range(80))


def test_a_table_can_replace_itself(spark, tmp_path):
    path = str(tmp_path / "r")
    sinks.replace_table(spark.range(10), path)
    sinks.replace_table(spark.read.parquet(sinks.current(spark, path)).where("id > 5"), path)
    assert spark.read.parquet(sinks.current(spark, path)).count() == 4


def test_fan_out_passes_the_batch_unchanged(spark, tmp_path):
    data = sample(8, 30)
    land(readings(spark, *data), tmp_path / "in")
    seen = {}
    writers = {
        "first": lambda df, i: seen.setdefault("first", []).extend(rows(df, "meter_id", "seq")),
        "second": lambda df, i: seen.setdefault("second", []).append(df.count()),
    }
    stream = streams.readings_stream(spark, str(tmp_path / "in"))
    pipeline.start_fan_out(stream, writers, str(tmp_path / "cp"), once=True).awaitTermination()
    assert seen["first"] == sorted((r[2], r[4]) for r in data) and seen["second"] == [30]


def test_repeats_are_dropped_on_a_stream(spark, tmp_path):
    data = sample(9, 20)
    land(readings(spark, *data, *data), tmp_path / "in")
    land(readings(spark, *data[-3:]), tmp_path / "in")
    stream = streams.readings_stream(spark, str(tmp_path / "in"), 1)
    run(windows.drop_repeats(stream, "10 minutes").writeStream, tmp_path / "out", tmp_path / "cp")
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_clustered_table_prunes_and_expires(spark, tmp_path):
    from wattspark.operators import filters

    path = str(tmp_path / "t")
    sinks.write_clustered(readings(spark, *[reading(86_400 * d) for d in range(5)]), path)
    df = tables.read_readings(spark, path)
    near = filters.since(df, "2025-12-29 12:00:00", 3600)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan and near.count() == 2
    assert sinks.drop_expired(spark, path, "2025-12-30", 2) == ["2025-12-26", "2025-12-27"]
    assert tables.read_readings(spark, path).count() == 3
    assert sinks.retained(df.sparkSession.read.parquet(path), "2025-12-30", 1).count() == 2


def test_archive_round_trip_keeps_microseconds(spark, tmp_path):
    df = readings(spark, reading(0.123456, quality_flags=["estimated"]), reading(61, 210.0))
    sinks.write_archive(df, str(tmp_path / "raw"))
    back = tables.read_archive(spark, str(tmp_path / "raw"))
    assert rows(back) == rows(df)


def test_kafka_records_take_the_message_layout(spark):
    df = spark.createDataFrame(
        [(bytearray(b"{}"), [("pole_id", bytearray(b"p1"))], None)],
        "value BINARY, headers ARRAY<STRUCT<key: STRING, value: BINARY>>, timestamp TIMESTAMP",
    )
    got = streams.from_kafka(df)
    assert got.columns == ENVELOPE.names and got.first().attributes == {"pole_id": "p1"}


def test_merged_events_stay_single(spark, tmp_path):
    path = str(tmp_path / "events")
    times = ["2025-12-26 10:00:00", "2025-12-26 11:00:00", "2025-12-27 10:00:00"]
    rows = spark.createDataFrame(
        [(f"e{i}", "m1", "p1", t, 1) for i, t in enumerate(times)] + [("e0", "m1", "p1", times[0], 1)],
        "event_id string, meter_id string, pole_id string, start string, v int",
    ).selectExpr("event_id", "meter_id", "pole_id", "CAST(start AS TIMESTAMP) AS event_start", "v")
    for _ in range(2):
        sinks.merge_rows(rows, path)
    sinks.merge_rows(rows.filter("event_id = 'e1'").withColumn("v", F.lit(2)), path)
    sinks.merge_rows(rows.limit(0), path)
    got = spark.read.parquet(path).collect()
    assert sorted((r.event_id, r.v) for r in got) == [("e0", 1), ("e1", 2), ("e2", 1)]


def test_compaction_keeps_rows_and_finishes_a_cut_job(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    df = readings(spark, *[reading(86_400 * (i % 3), seq=i) for i in range(30)])
    for n in range(3):
        sinks.append_batch(df.filter(f"seq % 3 = {n} OR seq % 2 = {n}"), path, "s", n)
    before = sorted(tables.read_readings(spark, path).collect())
    first = sorted(f.name for f in (tmp_path / "t").iterdir() if f.name.startswith("event_date="))[0]
    real = sinks.replacing

    def cut(*_):
        raise OSError("cut short")

    monkeypatch.setattr(sinks, "replacing", cut)
    with pytest.raises(OSError):  # after the date's folder went
        sinks.compact(spark, path, [first.split("=")[1]])
    assert tables.read_readings(spark, path).count() < len(before)
    monkeypatch.setattr(sinks, "replacing", real)
    for _ in range(2):
        sinks.compact(spark, path, [first.split("=")[1]])
        assert sorted(tables.read_readings(spark, path).collect()) == before
    assert len(list((tmp_path / "t" / first).glob("stream=*/batch=*/*.parquet"))) == 1


def test_a_write_that_dies_leaves_the_table_and_a_repeat_completes_it(spark, tmp_path):
    """A task fails; and a commit that moved only some of the batch's dates."""
    path = str(tmp_path / "t")
    sinks.write_clustered(readings(spark, *[reading(86_400 * d, seq=d) for d in range(4)]), path)
    more = readings(spark, *[reading(86_400 * d, seq=100 + d) for d in range(4)])
    broken = more.withColumn("meter_id", F.when(F.col("seq") < 103, F.col("meter_id")).otherwise(F.raise_error(F.lit("died"))))
    with pytest.raises(Exception, match="died"):
        sinks.append_batch(broken, path, "s", 0)
    assert tables.read_readings(spark, path).count() == 4
    sinks.append_batch(more, path, "s", 0)
    moved = sorted((tmp_path / "t").glob("event_date=*/stream=s/batch=0"))
    assert len(moved) == 4
    for folder in moved[2:]:
        sinks.remove(spark, str(folder))
    sinks.append_batch(more, path, "s", 0)
    assert sorted(r.seq for r in tables.read_readings(spark, path).collect()) == [0, 1, 2, 3, 100, 101, 102, 103]


def test_a_batch_of_many_folders(spark, tmp_path):
    data = [reading(60 * i, seq=i, pole_id=f"pole_{i % 7}") for i in range(300)]
    for _ in range(2):
        sinks.archive_batch(readings(spark, *data), str(tmp_path / "raw"), "s", 3, files_per_folder=1)
    assert sorted(r.seq for r in tables.read_archive(spark, str(tmp_path / "raw")).collect()) == list(range(300))
    assert len(list((tmp_path / "raw").glob("pole_id=*/dt=*/hr=*/min=*/stream=s/batch=3"))) == 300


def test_rows_without_a_time_are_merged_like_others(spark, tmp_path):
    path = str(tmp_path / "events")
    make = lambda *r: spark.createDataFrame(r, "event_id string, meter_id string, pole_id string, event_start timestamp, v int")
    at = datetime(2025, 12, 26, 10)
    sinks.merge_rows(make(("e1", "m", "p", None, 1), ("e2", "m", "p", None, 1), ("e4", "m", "p", at, 1)), path)
    sinks.merge_rows(make(("e3", "m", "p", None, 1), ("e2", "m", "p", None, 2)), path)
    got = spark.read.parquet(path).collect()
    assert sorted((r.event_id, r.v) for r in got) == [("e1", 1), ("e2", 2), ("e3", 1), ("e4", 1)]


def test_retention_of_tables_and_archive_with_rows_without_a_time(spark, tmp_path):
    table, raw = str(tmp_path / "t"), str(tmp_path / "raw")
    undated = readings(spark, reading(0, seq=99)).withColumn("event_ts", F.lit(None).cast("timestamp"))
    data = readings(spark, *[reading(86_400 * d, seq=d, pole_id=f"p{d % 2}") for d in range(5)]).unionByName(undated)
    sinks.write_clustered(data, table)
    sinks.write_archive(data, raw)
    for path, column, read in ((table, "event_date", tables.read_readings), (raw, "dt", tables.read_archive)):
        assert sinks.drop_expired(spark, path, "2025-12-30", 2, column) == ["2025-12-26", "2025-12-27"]
        assert sorted(r.seq for r in read(spark, path).collect()) == [2, 3, 4, 99]  # written today
        assert sinks.drop_expired(spark, path, "2999-01-01", 2, column) == ["2025-12-28", "2025-12-29", "2025-12-30"]
        assert not list((tmp_path / path.split("/")[-1]).glob("**/*.parquet")) and not list((tmp_path / path.split("/")[-1]).glob("**/*.json*"))
    assert sinks.drop_expired(spark, str(tmp_path / "empty"), "2025-12-30", 2) == []


def test_readers_find_a_version_while_the_next_is_written(spark, tmp_path):
    path = str(tmp_path / "r")
    with pytest.raises(FileNotFoundError):
        sinks.current(spark, path)
    for n in (1, 2, 3):
        sinks.replace_table(spark.range(n), path)
        assert spark.read.parquet(sinks.current(spark, path)).count() == n
    with pytest.raises(Exception, match="died"):
        sinks.replace_table(spark.range(4).select(F.raise_error(F.lit("died")).alias("id")), path)
    assert spark.read.parquet(sinks.current(spark, path)).count() == 3
    assert sorted(f.name for f in (tmp_path / "r").glob("version=*")) == ["version=2", "version=3", "version=4"]
    sinks.replace_table(spark.range(5), path)
    assert spark.read.parquet(sinks.current(spark, path)).count() == 5


def test_a_batch_reads_only_the_time_of_its_messages(spark, tmp_path):
    sent = datetime(2025, 12, 26, 12)
    row = lambda i, hours: (bytearray(b"%d" % i), {}, None if hours is None else sent + timedelta(hours=6 * hours))
    make = lambda *r: spark.createDataFrame(list(r), ENVELOPE)
    delivered = pipeline.Delivered(spark, str(tmp_path / "d"), "30 days")
    for n in range(6):
        batch = make(row(n, n), row(n, n), row(100 + n, None))
        assert delivered.first_time(batch, n).count() == 2
        delivered.remember(delivered.first_time(batch, n), n)
    assert [f.split("/keys/")[1] for f in delivered.reads(make(row(9, 6)), 6)] == []
    assert [f.split("/keys/")[1] for f in delivered.reads(make(row(3, 3), row(9, 6)), 6)] == ["_span=81797/batch_id=3"]
    assert delivered.first_time(make(row(3, 3), row(9, 3), row(103, None)), 6).count() == 1


def test_a_message_from_the_future_does_not_stop_forgetting(spark, tmp_path):
    sent = datetime(2025, 12, 26, 12, tzinfo=timezone.utc)
    delivered = pipeline.Delivered(spark, str(tmp_path / "d"), "1 hour")
    for n in range(6):
        at = sent + timedelta(hours=n)
        times = [at, datetime(2999, 1, 1, tzinfo=timezone.utc)] if n == 1 else [at]
        batch = spark.createDataFrame([(bytearray(b"%d" % n), {}, t) for t in times], ENVELOPE)
        delivered.remember(delivered.first_time(batch, n), n, at)
    assert sorted(int(f.name.split("=")[1]) for f in (tmp_path / "d" / "marks").iterdir()) == [3, 4, 5]
    assert sorted(f.name for f in (tmp_path / "d" / "keys").glob("*/*")) == ["batch_id=3", "batch_id=4", "batch_id=5"]


def test_panes_are_told_by_the_watermark(spark, tmp_path):
    write = pipeline.pane_writer(str(tmp_path / "m"), 60, "10 seconds")
    parts = [[0, 30], [40, 65], [50, 75], [20, 200], [100]]  # seconds of the readings of each batch
    for n, seconds in enumerate(parts):
        for _ in range(2 if n == 3 else 1):  # one is repeated
            write(readings(spark, *[reading(s) for s in seconds]), n)
    got = spark.read.parquet(str(tmp_path / "m")).filter("metric = 'power_total_kw'")
    shown = rows(got.withColumn("end", F.unix_seconds("end_time") - F.lit(1766750400)), "batch_id", "end", "pane", "value")
    assert shown == [
        (0, 60, "EARLY", 2.0), (1, 60, "EARLY", 1.0), (1, 120, "EARLY", 1.0), (2, 60, "ON_TIME", 1.0), (2, 120, "EARLY", 1.0),
        (3, 60, "LATE", 1.0), (3, 240, "EARLY", 1.0), (4, 120, "LATE", 1.0),
    ]


def test_corrections_bring_back_what_windows_drop(spark, tmp_path):
    root, data = str(tmp_path), [[1, 2], [300], [600], [3, 301], [900]]
    for n, seconds in enumerate(data):
        land(readings(spark, *[reading(s, meter=f"m{n}") for s in seconds]), tmp_path / "in")
        stream = streams.readings_stream(spark, str(tmp_path / "in"))
        writers = {"table": pipeline.table_writer(f"{root}/t", "x"), "late": windows.late_rows(f"{root}/late", delay="0 seconds")}
        pipeline.start_fan_out(stream, writers, f"{root}/c1", once=True).awaitTermination()
        pipeline.start_minute_aggregates(stream, f"{root}/agg", f"{root}/c2", once=True, delay="0 seconds").awaitTermination()
    count = lambda df: rows(df.orderBy("window_start"), "reading_count")
    stored = tables.read_table(spark, f"{root}/agg")
    assert count(stored) == [(1,), (1,), (2,)]  # 0, 300 and 600 seconds
    for _ in range(2):
        windows.correct_windows(spark, f"{root}/late", f"{root}/t", f"{root}/corrections")
        fixed = windows.corrected(stored, tables.read_table(spark, f"{root}/corrections"))
        batch = rollups.pole_window_stats(tables.read_readings(spark, f"{root}/t")).filter("window_start < '2025-12-26 12:15:00'")
        assert rows(fixed) == rows(batch) and count(fixed) == [(1,), (2,), (3,)]


@pytest.mark.parametrize("gap", [15, 40])
def test_sag_stream_splits_at_long_gaps_like_batch(spark, tmp_path, gap):
    rnd, at, data = random.Random(gap), 0, []
    for i in range(120):
        at += rnd.choice([5, 10, 30, 60])
        data.append(reading(at, rnd.choice([199.0, 212.0, 215.0, 235.0]), f"m{i % 2}", seq=i))
    state = sags.SagState(str(tmp_path / "state"), delay_seconds=0, slice_seconds=60, max_gap_seconds=gap)
    for n in range(4):
        state.step(readings(spark, *data[n * 30 : n * 30 + 30]), n)
    columns = ("meter_id", "pole_id", "event_start", "reading_count", "min_voltage_v", "severity")
    batch = voltage.sag_events(readings(spark, *data), slice_seconds=60, max_gap_seconds=gap)
    assert events_of(spark, state, 3) == rows(batch, *columns)
    assert batch.count() != voltage.sag_events(readings(spark, *data)).count()


def test_deliveries_are_staged_by_parts_in_one_pass(spark):
    sent = [datetime(2024, 1, d, h, 30) for d in (1, 8, 9, 15, 16, 22, 23, 30) for h in (0, 23)] * 10
    made = [(bytearray(b"%d" % i), {}, t) for i, t in enumerate(sent)] + [(None, {}, sent[2]), (bytearray(b"x"), {}, None)]
    bounds = [datetime.fromisoformat(t) for t in stream_queries.PARTS]
    want = []
    for data, _, at in made:
        crc = None if data is None else zlib.crc32(bytes(data))
        late = crc is not None and crc % 11 == 1
        for n in range(4) if at is not None else ():
            since, until = bounds[n - 1] if n else datetime.min, bounds[n] if n < 3 else datetime.max
            due = at < until and (n == 3 or not late) and (n == 0 or at >= since - timedelta(hours=1))
            missed = n > 0 and late and at < since and (n == 1 or at >= bounds[n - 2])
            if due or missed:
                want += [(data and bytes(data), n)] * (2 if crc is not None and crc % 5 == 0 else 1)
    # random numbers of a row differ each time the rows are computed: each row is computed once
    rows_made = spark.createDataFrame(made, ENVELOPE).withColumn("once", F.rand())
    got = stream_queries._deliveries(rows_made)
    key = lambda r: (r[0] is None, r[0] or b"", r[1])
    assert sorted(((r.data and bytes(r.data), r.part) for r in got.collect()), key=key) == sorted(want, key=key)
    assert got.select("data", "once").distinct().count() == len({k for k, _ in want})


def test_sinks_keep_neither_bodies_nor_members(spark, tmp_path):
    messages(spark, tmp_path, 10)
    checked = ingest.validate(ingest.parse(spark.read.schema(ENVELOPE).parquet(str(tmp_path))), START)
    kept = ingest.sorted_out(checked, START)
    assert kept.columns == ["status", *READINGS.names, "value"]
    assert rows(ingest.sorted_readings(kept)) == rows(ingest.enrich(ingest.successes(checked), START))
    assert rows(ingest.sorted_letters(kept)) == rows(ingest.error_bytes(ingest.errors(checked)))
