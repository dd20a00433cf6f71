import random

import pytest
from pyspark.sql import Window, functions as F

from tests.build import reading, readings, rows
from wattspark.operators import sliced, voltage


def brute_runs(rows_, low=220.0):
    """Runs of low readings per meter, split by pole, found one reading at a time."""
    found = {}
    by_meter = {}
    for r in rows_:
        by_meter.setdefault(r[2], []).append(r)
    for meter, own in by_meter.items():
        breaks = 0
        for r in sorted(own, key=lambda r: (r[0], r[4])):
            if r[5] < low:
                found.setdefault((meter, r[3], breaks), []).append(r)
            else:
                breaks += 1
    return sorted(
        (m, p, len(g), min(r[5] for r in g), max(r[5] for r in g)) for (m, p, _), g in found.items()
    )


def noisy(seed=7, hot=600):
    """One meter holds most rows; poles change now and then; some times repeat."""
    rnd = random.Random(seed)
    out = []
    for i in range(hot):
        pole = "pole_A" if rnd.random() < 0.9 else "pole_B"
        out.append(reading(i * 7.3, rnd.choice([200.0, 215.0, 240.0, 262.0]), "hot", pole, seq=i))
    for m in range(5):
        for i in range(20):
            out.append(reading(rnd.randrange(4000), rnd.uniform(190, 250), f"m{m}", seq=i))
    return out


@pytest.mark.parametrize("width", [1, 600, 10**7])
def test_runs_do_not_depend_on_the_slice(spark, width):
    data = noisy()
    got = voltage.sag_events(readings(spark, *data), 220.0, 1, width)
    shown = rows(got, "meter_id", "pole_id", "reading_count", "min_voltage_v", "max_voltage_v")
    assert shown == brute_runs(data)


def test_durations_and_severity(spark):
    df = readings(
        spark,
        reading(0, 219.0), reading(4, 205.0), reading(5, 240.0),
        reading(10, 199.0), reading(13.9, 215.0), reading(20, 221.0),
        reading(30, 212.0),
    )
    got = rows(voltage.sag_events(df), "reading_count", "duration_seconds", "severity")
    assert got == [(2, 5, "WARNING")]
    everything = rows(
        voltage.sag_events(df, min_duration_seconds=1), "reading_count", "duration_seconds", "severity"
    )
    assert everything == [(1, 1, "MINOR"), (2, 4, "CRITICAL"), (2, 5, "WARNING")]


def test_time_without_readings_does_not_split_a_run(spark):
    df = readings(spark, reading(0, 210.0), reading(90_000, 211.0))
    assert rows(voltage.sag_events(df), "duration_seconds") == [(90_001,)]


def test_limits_are_exclusive(spark):
    df = readings(spark, reading(0, 220.0), reading(1, 260.0))
    assert voltage.sag_events(df, min_duration_seconds=1).count() == 0
    assert voltage.swell_events(df, min_duration_seconds=1).count() == 0


def test_swell_and_critical(spark):
    df = readings(spark, *[reading(i, 261.0) for i in range(5)], *[reading(10 + i, 199.0) for i in range(3)])
    assert rows(voltage.swell_events(df), "reading_count", "severity") == [(5, "MINOR")]
    assert rows(voltage.critical_sag_events(df), "reading_count", "severity") == [(3, "CRITICAL")]


def test_anomaly_report_checks_its_arguments(spark):
    df = readings(spark, reading())
    for bad in ({"limit": 0}, {"limit": 1001}, {"min_duration_seconds": 0}):
        with pytest.raises(ValueError):
            voltage.anomalies(df, "2025-12-26 00:00:00", "2025-12-27 00:00:00", **bad)


def test_every_low_reading_is_in_exactly_one_run(spark):
    data = noisy(3)
    df = readings(spark, *data)
    counted = voltage.sag_events(df, min_duration_seconds=1).agg(F.sum("reading_count")).first()[0]
    assert counted == sum(r[5] < 220 for r in data)


@pytest.mark.parametrize("width", [5, 3600])
def test_row_numbers_equal_plain_windows(spark, width):
    df = readings(spark, *noisy(5))
    plain = Window.partitionBy("meter_id").orderBy("event_ts", "seq")
    low = F.col("voltage_v") < 220
    want = df.withColumn("rn", F.row_number().over(plain)).withColumn(
        "rn_group",
        F.row_number().over(Window.partitionBy("meter_id", low).orderBy("event_ts", "seq")),
    )
    got = voltage.number_readings(df, slice_seconds=width)
    cols = ("meter_id", "event_ts", "seq", "rn", "rn_group")
    assert rows(got, *cols) == rows(want, *cols)


@pytest.mark.parametrize("width", [1, 60])
def test_pairs_equal_plain_lag(spark, width):
    df = readings(spark, *noisy(11))
    plain = Window.partitionBy("meter_id").orderBy("event_ts", "seq")
    want = df.withColumn("prev_seq", F.lag("seq").over(plain)).filter("prev_seq IS NOT NULL")
    got = sliced.consecutive_pairs(df, ["meter_id"], ["event_ts", "seq"], ["seq"], width)
    cols = ("meter_id", "event_ts", "seq", "prev_seq")
    assert rows(got, *cols) == rows(want, *cols)


@pytest.mark.parametrize("seconds", [4, 50])
def test_trailing_count_equals_range_frame(spark, seconds):
    df = readings(spark, *noisy(13))
    df.createOrReplaceTempView("trailing_input")
    want = spark.sql(
        f"""SELECT meter_id, event_ts, seq, count_if(voltage_v < 220) OVER (PARTITION BY meter_id
        ORDER BY event_ts RANGE BETWEEN INTERVAL {seconds} SECONDS PRECEDING AND CURRENT ROW)
        AS low_voltage_count FROM trailing_input"""
    )
    got = voltage.rolling_low_voltage(df, seconds, slice_seconds=20)
    cols = ("meter_id", "event_ts", "seq", "low_voltage_count")
    assert rows(got, *cols) == rows(want, *cols)


@pytest.mark.parametrize("width", [1, 86_400])
def test_null_keys_are_a_key_of_their_own(spark, width):
    data = [reading(i * 7, 210.0 if i % 2 else 240.0, "none" if i % 3 else "m", seq=i) for i in range(60)]
    df = readings(spark, *data).withColumn("meter_id", F.nullif("meter_id", F.lit("none")))
    plain = Window.partitionBy("meter_id").orderBy("event_ts", "seq")
    want = df.withColumn("rn", F.row_number().over(plain))
    got = voltage.number_readings(df, slice_seconds=width)
    assert sorted((r.seq, r.rn) for r in got.collect()) == sorted((r.seq, r.rn) for r in want.collect())


def test_event_rows_layout(spark):
    from wattspark.schemas import VOLTAGE_EVENTS

    events = voltage.sag_events(readings(spark, reading(0, 199.0), reading(6, 205.0)))
    stored = voltage.event_rows(events, "sag", "2025-12-27 00:00:00")
    assert stored.columns == VOLTAGE_EVENTS.names
    assert (stored.first().severity, len(stored.first().event_id)) == ("critical", 64)


def test_long_gaps_split_a_run_only_if_asked(spark):
    data = readings(spark, *[reading(s, 210.0) for s in (0, 10, 20, 100, 110, 131)])
    shown = lambda **more: rows(voltage.sag_events(data, min_duration_seconds=1, slice_seconds=50, **more), "reading_count")
    assert shown() == [(6,)]
    assert shown(max_gap_seconds=80) == [(6,)]
    assert shown(max_gap_seconds=79) == [(3,), (3,)]
    assert shown(max_gap_seconds=20) == [(1,), (2,), (3,)]
    with pytest.raises(ValueError):
        shown(max_gap_seconds=0)
