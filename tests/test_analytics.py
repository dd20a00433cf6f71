import pytest
from pyspark.sql import functions as F

from tests.build import START, reading, readings, rows
from wattspark.functions import columns as c
from wattspark.functions.quality import composite_score
from wattspark.operators import (
    dashboard,
    delivery,
    demand_response as dr,
    der,
    feeder,
    filters,
    gauges,
    health,
    rollups,
)


def three(spark):
    return readings(
        spark,
        reading(0, 238.0, "m1", kw=1.0),
        reading(1, 242.0, "m2", kw=1.5),
        reading(2, 210.0, "m3", kw=0.8),
    )


def test_gauges_of_three_readings(spark):
    g = gauges.batch_gauges(three(spark), "2025-12-26 12:01:00").first()
    assert (g.voltage_avg, g.voltage_min, g.voltage_max) == (230.0, 210.0, 242.0)
    assert g.power_total_kw == pytest.approx(3.3) and g.voltage_sag_count == 1
    assert g.health_score == pytest.approx(66.666667) and g.active_meter_count == 3


def test_series_have_seven_gauges_and_their_types(spark):
    series = gauges.to_series(gauges.batch_gauges(three(spark), "2025-12-26 12:01:00"))
    kinds = {r.metric: r.value_type for r in series.collect()}
    assert kinds == gauges.GAUGES


def test_no_readings_no_gauges(spark):
    empty = three(spark).limit(0)
    assert gauges.to_series(gauges.pole_gauges(empty)).count() == 0
    assert rollups.pole_summary(empty, "pole_A", "2025-01-01 00:00:00", "2026-01-01 00:00:00").count() == 0


def test_missing_pole_is_unknown(spark):
    rows_ = three(spark).withColumn("pole_id", F.lit(None).cast("string"))
    assert gauges.batch_gauges(rows_, "2025-12-26 12:01:00").first().pole_id == "unknown"


def test_score_is_null_without_deviation(spark):
    df = spark.range(1).select(
        composite_score(F.lit(1), F.lit(3600), F.lit(0), F.lit(None).cast("double")).alias("none"),
        composite_score(F.lit(3600), F.lit(3600), F.lit(0), F.lit(0.0)).alias("full"),
        composite_score(F.lit(9000), F.lit(3600), F.lit(9000), F.lit(50.0)).alias("bad"),
    )
    assert tuple(df.first()) == (None, 100.0, 25.0)


def test_hourly_health_values(spark):
    row = health.hourly_health(three(spark), sample_interval_seconds=1200).first()
    assert (row.expected_readings, row.missing_readings, row.data_completeness_pct) == (9, 6, 33.33)
    assert row.estimated_power_factor is None and row.low_voltage_pct == 33.33


def test_join_form_equals_column_form(spark):
    metrics = health.hourly_metrics(three(spark))
    a = rows(health.with_expected_readings(metrics), "pole_id", "expected_readings")
    assert a == rows(health.with_expected_readings_joined(metrics), "pole_id", "expected_readings")


def test_daily_counts_equal_hourly_counts(spark):
    df = readings(spark, *[reading(i * 1700, 200.0 + i, f"m{i % 3}") for i in range(60)])
    hourly = health.hourly_health(df)
    total = health.daily_health(hourly).agg(F.sum("total_readings")).first()[0]
    assert total == hourly.agg(F.sum("total_readings")).first()[0] == 60


def test_safe_divide_and_strict_extremes(spark):
    n = F.lit(None).cast("double")
    row = spark.range(1).select(
        c.safe_divide(F.lit(1), F.lit(0)),
        c.strict_least(F.lit(1.0), n),
        c.strict_greatest(n, F.lit(1.0)),
        c.round_stable(F.lit(198.14499999999998), 2),
        c.seconds_between(c.instant("2025-01-01 00:00:00.9"), c.instant("2025-01-01 00:00:02.1")),
        c.day_of_week(c.instant("2025-12-28 10:00:00")),
        c.device_type_of(F.lit("DER-wind-3")),
    ).first()
    assert tuple(row) == (None, None, None, 198.15, 1, 1, "wind")


def baseline_days(spark):
    """Monday to Sunday before the event, 1 kW at 12:00 of day one rising by 1 kW a day."""
    days = [reading(-86_400 * d, kw=float(8 - d)) for d in range(1, 8)]
    return readings(spark, *days, reading(60, kw=2.0), reading(600, kw=5.0))


def test_baseline_leaves_out_weekends_and_today(spark):
    base = dr.baseline(baseline_days(spark), "2025-12-26", 7, "2025-12-26 00:00:00")
    row = base.collect()
    # Fri 19 (1), Mon 22 (4), Tue 23 (5), Wed 24 (6), Thu 25 (7)
    assert len(row) == 1 and row[0].baseline_days_count == 5
    assert (row[0].baseline_avg_kw, row[0].baseline_median_kw, row[0].time_of_day) == (4.6, 5.0, "12:00")


def test_baseline_without_a_holiday(spark):
    holidays = spark.createDataFrame([("2025-12-25",)], "d STRING").select(F.to_date("d").alias("event_date"))
    base = dr.baseline(baseline_days(spark), "2025-12-26", 7, "2025-12-26 00:00:00", holidays)
    assert (base.first().baseline_days_count, base.first().baseline_avg_kw) == (4, 4.0)


def test_event_scores_treat_missing_baselines_differently(spark):
    df = baseline_days(spark)
    base = dr.baseline(df, "2025-12-26", 7, "2025-12-26 00:00:00")
    kept = dr.event_performance(df, base, "2025-12-26", 12, 13).first()
    # slots 12:00 (2 kW against 4.6) and 12:10 (5 kW, no baseline)
    assert kept.avg_actual_kw == 3.5 and kept.avg_baseline_kw == 2.3
    assert kept.avg_reduction_kw == pytest.approx(1.3) and kept.avg_reduction_percent == pytest.approx(56.521739)
    filled = dr.compute_event(df, base, ["pole_A"], "2025-12-26", 12, 13).first()
    assert filled.avg_reduction_kw == -1.2 and filled.total_reduction_kwh == -0.2
    assert dr.event_total(dr.compute_event(df, base, ["pole_A"], "2025-12-26", 12, 13)).first().poles == 1


def test_event_hours_reach_midnight_and_are_checked(spark):
    df = readings(spark, reading(11 * 3600 + 1800))
    assert filters.event_hours(df, "2025-12-26", 23, 24).count() == 1
    assert filters.event_hours(df, "2025-12-26", 22, 23).count() == 0
    with pytest.raises(ValueError):
        filters.event_hours(df, "2025-12-26", 5, 25)


def test_presets(spark):
    df = readings(spark, reading())
    expected = {
        p: delivery.meter_day_completeness(df, p).first().expected_readings
        for p in delivery.SAMPLING_PRESETS
    }
    assert expected == {"high_frequency": 2880, "standard": 288, "low_frequency": 96}


def test_delivery_counts(spark):
    df = readings(
        spark,
        reading(0, seq=1), reading(30, seq=2, delay=200), reading(60, seq=5), reading(90, seq=6),
    )
    row = delivery.delivery_stats(df).first()
    assert (row.received, row.lost, row.reordered) == (4, 2, 1)
    assert delivery.sequence_gaps(df).first().lost == 2


def test_gap_report(spark):
    df = readings(spark, reading(0), reading(30), reading(120), reading(215))
    got = rows(delivery.reading_gaps(df, 30, 2.0), "missing_readings")
    assert got == [(2,), (3,)]


def test_latency_bands(spark):
    df = readings(spark, reading(0, delay=0.02), reading(1, delay=0.5), reading(2, network_profile=None))
    got = {r.network_profile: r.out_of_band for r in delivery.latency_by_profile(df).collect()}
    assert got == {"wired": 1, None: 0}


def test_load_curve(spark):
    hours = [0.0, 5.5, 7.0, 9.5, 12.0, 16.5, 20.0, 21.5, 23.9]
    df = spark.createDataFrame([(h,) for h in hours], "h DOUBLE")
    got = [round(r[0], 6) for r in df.select(delivery.expected_load(F.col("h"))).collect()]
    assert got == [0.4, 1.45, 2.5, 1.75, 1.0, 2.5, 4.0, 2.2, 0.4]


def test_tile_states(spark):
    df = spark.createDataFrame([(5,), (6,), (21,)], "v INT")
    got = [r[0] for r in df.select(dashboard.tile_state(F.col("v"), "voltage_sag_count")).collect()]
    assert got == ["GREEN", "YELLOW", "RED"]
    low = spark.createDataFrame([(79.0,), (94.0,), (95.0,)], "v DOUBLE")
    got = [r[0] for r in low.select(dashboard.tile_state(F.col("v"), "health_score")).collect()]
    assert got == ["RED", "YELLOW", "GREEN"]


def fleet(spark, *items):
    return spark.createDataFrame(
        [(d, d.split("-")[1], START.replace(hour=h, minute=m), kw) for d, h, m, kw in items],
        "device_id STRING, device_type STRING, ts TIMESTAMP, power_output DOUBLE",
    )


def test_slots_average_each_device_first(spark):
    df = fleet(
        spark, ("DER-PV-1", 12, 0, 60.0), ("DER-PV-1", 12, 1, 80.0), ("DER-wind-1", 12, 4, 30.0),
        ("DER-PV-1", 12, 5, 99.0), ("DER-PV-1", 12, 10, 100.0), ("DER-PV-1", 12, 15, 120.0),
        ("DER-PV-1", 12, 25, 100.0),
    )
    assert sorted(r.total_kw for r in der.fleet_slots(df).collect()) == [99.0, 100.0, 100.0, 100.0, 120.0]
    periods = sorted(der.eligible_periods(df).collect(), key=lambda r: r.period_start)
    assert [(r.slots, r.min_kw, r.avg_kw) for r in periods] == [
        (1, 100.0, 100.0), (2, 100.0, 110.0), (1, 100.0, 100.0),
    ]
    totals = {r.device_type: r.total_kw for r in der.fleet_slots_by_type(df).collect() if r.slot_start.minute == 0}
    assert totals == {"PV": 70.0, "wind": 30.0, None: 100.0}


def test_wind_off_the_curve_is_null(spark):
    df = spark.createDataFrame(
        [("wind", 5.0, 47.5), ("wind", 40.0, 50.0)],
        "device_type STRING, wind_speed DOUBLE, nameplate_capacity DOUBLE",
    )
    got = {r.wind_speed: r.expected_kw for r in der.with_curve_power(df, der.wind_curve(spark)).collect()}
    assert got == {5.0: 7.3, 40.0: None}


def test_feeder_profile(spark):
    one = spark.createDataFrame([("a", 1.0, 5.0)], "s STRING, house_kw DOUBLE, pv_kw DOUBLE")
    profile = feeder.net_load_profile(one)
    assert profile.count() == 24
    row = feeder.net_load_summary(profile, "s").first()
    assert (row.peak_net_kw, row.max_export_kw, row.reverse_flow_hours) == (7.0, 4.0, 7)


def test_five_minute_views_and_rollup_differ(spark):
    df = readings(spark, reading(0), reading(60), reading(240))
    assert rollups.minute_load_profile(df).count() == 3
    assert rows(rollups.pole_interval_rollup(df), "reading_count") == [(3,)]


def test_first_of_each_keeps_the_earliest(spark):
    df = readings(spark, reading(5, 1.0, seq=1), reading(3, 2.0, seq=1), reading(9, 3.0, seq=2))
    got = rollups.first_of_each(df, ["meter_id", "seq"])
    assert got.columns == df.columns and rows(got, "seq", "voltage_v") == [(1, 2.0), (2, 3.0)]
