"""Energy-resource fleet, feeder and scalar-function queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from wattspark.functions import columns as c
from wattspark.operators.quantiles import exact_quantiles
from wattspark.operators import der, feeder
from wattspark.plans.projections import events, fleet, readings
from wattspark.plans.registry import query
from wattspark.schemas import DER_METRICS
from wattspark.sources.tables import edge_messages, read_wind_curve
from wattspark.session import scratch_dir

WIDE = (
    "SELECT device_id, device_type, ts, capacity, power_output, run_time, cycle_life, dischargable, "
    "nominal_power, performance_ratio, nameplate_capacity, wind_speed, seq FROM fleet"
)
WIDE_DOUBLES = "capacity power_output run_time nominal_power nameplate_capacity wind_speed"


@query("u02_fleet_union", WIDE, WIDE_DOUBLES)
def fleet_union(spark, sf_dir):
    return fleet(spark, sf_dir)


@query(
    "p27_device_type_from_id",
    "SELECT split_part(device_id, '-', 2) AS device_type, count(*) AS messages, count(DISTINCT device_id) AS devices "
    "FROM fleet GROUP BY 1",
)
def device_type_from_id(spark, sf_dir):
    return (
        fleet(spark, sf_dir)
        .groupBy(c.device_type_of(F.col("device_id")).alias("device_type"))
        .agg(F.count(F.lit(1)).alias("messages"), F.count_distinct("device_id").alias("devices"))
    )


@query(
    "p28_minute_timestamps",
    "SELECT event_id, date_trunc('minute', ts) AS ts FROM events",
)
def minute_timestamps(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", F.date_trunc("minute", "ts").alias("ts"))


@query(
    "p29_edge_messages",
    "SELECT date_trunc('millisecond', ts) AS ts, CAST(42.5 AS DOUBLE) AS nameplate_capacity, "
    "CAST(5 + event_id % 20 AS BIGINT) AS wind_speed, value AS power_output, "
    "CAST(48 + user_id % 100 / 100.0 AS DOUBLE) AS longitude, CAST(11 + user_id % 100 / 100.0 AS DOUBLE) AS latitude FROM events",
    "power_output longitude latitude",
)
def edge(spark, sf_dir):
    share = F.col("user_id") % 100 / 100
    texts = events(spark, sf_dir).select(
        F.to_json(
            F.struct(
                F.unix_millis("ts").alias("timestamp"),
                F.lit(42.5).alias("nameplate_capacity"),
                (5 + F.col("event_id") % 20).alias("wind_speed"),
                F.col("value").alias("power_output"),
                F.struct((48 + share).alias("longitude"), (11 + share).alias("latitude")).alias(
                    "location"
                ),
            )
        ).alias("value")
    )
    return der.flatten_edge(edge_messages(texts))


CATALOGUE = ", ".join(
    f"('{kind}', '{metric}', '{type_}')"
    for kind, metrics in DER_METRICS.items()
    for metric, type_ in metrics.items()
)
METRICS = list(dict.fromkeys(m for kind in DER_METRICS.values() for m in kind))
SERIES_SQL = "series AS (SELECT * FROM (SELECT device_id, device_type, ts, " + ", ".join(
    f"CAST({m} AS DOUBLE) AS {m}" for m in METRICS
) + f" FROM fleet) UNPIVOT (value FOR metric IN ({', '.join(METRICS)})))"


@query(
    "s07_metric_catalogue",
    f"SELECT device_type, metric, type, count(*) AS reported FROM series JOIN (VALUES {CATALOGUE}) "
    "AS t(device_type, metric, type) USING (device_type, metric) GROUP BY ALL",
    "",
    (SERIES_SQL,),
)
def metric_catalogue(spark, sf_dir):
    """How often each metric of the catalogue was reported, by kind and declared type."""
    declared = F.create_map(
        *[
            F.lit(x)
            for kind, metrics in DER_METRICS.items()
            for name, type_ in metrics.items()
            for x in (f"{kind}.{name}", type_)
        ]
    )
    series = der.metric_series(fleet(spark, sf_dir))
    return (
        series.groupBy("device_type", "metric")
        .agg(F.count(F.lit(1)).alias("reported"))
        .withColumn("type", declared[F.concat_ws(".", "device_type", "metric")])
    )


@query("a38_metric_series", "SELECT device_id, device_type, ts, metric, value FROM series", "value", (SERIES_SQL,))
def metric_series(spark, sf_dir):
    return der.metric_series(fleet(spark, sf_dir))


SLOTS = """device_slots AS (
  SELECT time_bucket(INTERVAL 5 MINUTES, ts) AS slot_start, device_type, device_id, avg(power_output) AS kw
  FROM fleet GROUP BY ALL),
slots AS (SELECT slot_start, sum(kw) AS total_kw, count(*) AS devices FROM device_slots GROUP BY ALL)"""


@query("a27_fleet_slots", "SELECT * FROM slots", "total_kw", (SLOTS,))
def fleet_slots(spark, sf_dir):
    return der.fleet_slots(fleet(spark, sf_dir))


@query("a28_eligible_slots", "SELECT * FROM slots WHERE total_kw >= 100", "total_kw", (SLOTS,))
def eligible_slots(spark, sf_dir):
    return der.eligible_slots(fleet(spark, sf_dir))


@query(
    "a28_eligible_periods",
    "SELECT min(slot_start) AS period_start, max(slot_start) + INTERVAL 5 MINUTES AS period_end, count(*) AS slots, "
    "min(total_kw) AS min_kw, avg(total_kw) AS avg_kw FROM (SELECT *, slot_start - "
    "row_number() OVER (ORDER BY slot_start) * INTERVAL 5 MINUTES AS anchor FROM slots WHERE total_kw >= 60) GROUP BY anchor",
    "min_kw avg_kw",
    (SLOTS,),
)
def eligible_periods(spark, sf_dir):
    return der.eligible_periods(fleet(spark, sf_dir), 60.0)


@query(
    "a29_fleet_slots_by_type",
    "SELECT slot_start, device_type, sum(kw) AS total_kw, count(*) AS devices FROM device_slots "
    "GROUP BY GROUPING SETS ((slot_start, device_type), (slot_start))",
    "total_kw",
    (SLOTS,),
)
def fleet_slots_by_type(spark, sf_dir):
    return der.fleet_slots_by_type(fleet(spark, sf_dir))


@query(
    "a30_inventory",
    "SELECT device_type, any_value(declared) AS declared, count(DISTINCT device_id) AS seen, "
    "count(DISTINCT device_id) - any_value(declared) AS difference FROM (VALUES ('battery', CAST(2 AS BIGINT)), ('PV', 2), ('wind', 1), ('hydro', 1)) AS t(device_type, declared) "
    "LEFT JOIN fleet USING (device_type) GROUP BY device_type",
)
def inventory(spark, sf_dir):
    declared = spark.createDataFrame(
        [("battery", 2), ("PV", 2), ("wind", 1), ("hydro", 1)], "device_type STRING, declared BIGINT"
    )
    return der.inventory(fleet(spark, sf_dir), declared)


@query(
    "a34_battery_cycles",
    "SELECT device_id, count(*) AS readings, min(capacity) AS min_capacity, "
    "coalesce(sum(prev_kw * (epoch_us(ts) - epoch_us(prev_ts)) / 3600000000.0), 0) AS energy_kwh, "
    "count(*) FILTER (prev_on AND NOT dischargable) AS cycles_ended FROM (SELECT *, "
    "lag(power_output) OVER d AS prev_kw, lag(ts) OVER d AS prev_ts, lag(dischargable) OVER d AS prev_on "
    "FROM fleet WHERE device_type = 'battery' WINDOW d AS (PARTITION BY device_id ORDER BY ts, seq)) GROUP BY device_id",
    "min_capacity energy_kwh",
)
def battery_cycles(spark, sf_dir):
    return der.battery_cycles(fleet(spark, sf_dir))


@query(
    "a35_pv_performance",
    "SELECT device_id, CAST(ts AS DATE) AS event_date, avg(performance_ratio) AS avg_performance_ratio, "
    "max(power_output) AS peak_power_kw FROM fleet WHERE device_type = 'PV' GROUP BY ALL",
    "avg_performance_ratio peak_power_kw",
)
def pv_performance(spark, sf_dir):
    return der.pv_performance(fleet(spark, sf_dir))


EXPECTED = (
    "(SELECT f.*, round(c.kw * f.nameplate_capacity / 95, 1) AS expected_kw FROM fleet f "
    "LEFT JOIN curve c ON c.speed = f.wind_speed WHERE device_type = 'wind') AS w"
)


@query(
    "j04_wind_curve_lookup",
    f"SELECT device_id, ts, seq, wind_speed, power_output, expected_kw FROM {EXPECTED}",
    "wind_speed power_output expected_kw",
)
def wind_curve_lookup(spark, sf_dir):
    joined = der.with_curve_power(fleet(spark, sf_dir), der.wind_curve(spark))
    return joined.select("device_id", "ts", "seq", "wind_speed", "power_output", "expected_kw")


@query(
    "s05_wind_curve_from_csv",
    f"SELECT wind_speed, count(*) AS readings, max(expected_kw) AS expected_kw FROM {EXPECTED} GROUP BY wind_speed",
    "wind_speed expected_kw",
)
def wind_curve_from_csv(spark, sf_dir):
    path = scratch_dir(spark, "wind_curve")
    der.wind_curve(spark).coalesce(1).write.option("header", True).csv(path)
    joined = der.with_curve_power(fleet(spark, sf_dir), read_wind_curve(spark, path))
    return joined.groupBy("wind_speed").agg(
        F.count(F.lit(1)).alias("readings"), F.max("expected_kw").alias("expected_kw")
    )


@query(
    "a36_wind_underperformance",
    "SELECT device_id, ts, wind_speed, power_output, expected_kw, expected_kw - power_output AS shortfall_kw "
    f"FROM {EXPECTED} WHERE expected_kw - power_output > expected_kw * 0.2",
    "wind_speed power_output expected_kw shortfall_kw",
)
def wind_underperformance(spark, sf_dir):
    return der.wind_underperformance(fleet(spark, sf_dir), der.wind_curve(spark))


PROFILE = f"""scenarios AS (
  SELECT 'pole_' || CAST(user_id % 10 AS VARCHAR) AS pole_id, CAST(count(DISTINCT user_id) AS DOUBLE) AS house_kw,
    5.0 * count(DISTINCT user_id) FILTER (user_id % 3 = 1) AS pv_kw FROM events GROUP BY 1),
shape AS (
  SELECT unnest(range(24)) AS hour, unnest([CAST(x AS DOUBLE) FOR x IN string_split('{feeder.DEMAND_SHAPE}', ',')]) AS d,
    unnest([CAST(x AS DOUBLE) FOR x IN string_split('{feeder.SOLAR_SHAPE}', ',')]) AS s),
profile AS (
  SELECT pole_id, CAST(house_kw AS DOUBLE) AS house_kw, CAST(pv_kw AS DOUBLE) AS pv_kw, hour,
    house_kw * d AS demand_kw, CAST(pv_kw AS DOUBLE) * s AS solar_kw, house_kw * d - CAST(pv_kw AS DOUBLE) * s AS net_kw
  FROM scenarios, shape)"""


def _scenarios(spark, sf_dir):
    """One scenario per pole: a house per meter, a photovoltaic system on every third."""
    return (
        events(spark, sf_dir)
        .groupBy(F.concat(F.lit("pole_"), (F.col("user_id") % 10).cast("string")).alias("pole_id"))
        .agg(
            (F.count_distinct("user_id") * F.lit(feeder.HOUSE_KW)).alias("house_kw"),
            (
                F.count_distinct(F.when(F.col("user_id") % 3 == 1, F.col("user_id")))
                * F.lit(feeder.PV_KW)
            ).alias("pv_kw"),
        )
    )


@query(
    "j06_scenario_hours",
    "SELECT * FROM profile",
    "house_kw pv_kw demand_kw solar_kw net_kw",
    (PROFILE,),
)
def scenario_hours(spark, sf_dir):
    return feeder.net_load_profile(_scenarios(spark, sf_dir))


@query(
    "a37_feeder_net_load",
    "SELECT pole_id, max(net_kw) AS peak_net_kw, greatest(-min(net_kw), 0) AS max_export_kw, "
    "count(*) FILTER (net_kw < 0) AS reverse_flow_hours, sum(net_kw) AS net_kwh FROM profile GROUP BY pole_id",
    "peak_net_kw max_export_kw net_kwh",
    (PROFILE,),
)
def feeder_net_load(spark, sf_dir):
    profile = feeder.net_load_profile(_scenarios(spark, sf_dir))
    return feeder.net_load_summary(profile, "pole_id")


@query(
    "f01_calendar_functions",
    "SELECT event_id, CAST(ts AS DATE) AS event_date, CAST(ts AS DATE) - 10 AS ten_days_before, "
    "ts - INTERVAL 90 SECONDS AS ninety_seconds_before, date_trunc('minute', ts) AS minute_ts, "
    "date_trunc('hour', ts) AS hour_ts, date_sub('second', TIMESTAMP '2024-01-01', ts) AS seconds_since, "
    "CAST(extract(hour FROM ts) AS BIGINT) AS hour_of_day, dayofweek(ts) + 1 AS day_of_week, "
    "CAST(extract(minute FROM ts) // 5 * 5 AS BIGINT) AS minute_bucket, "
    "strftime(ts, '%H:') || lpad(CAST(extract(minute FROM ts) // 5 * 5 AS VARCHAR), 2, '0') AS time_of_day FROM events",
)
def calendar_functions(spark, sf_dir):
    ts = F.col("ts")
    return events(spark, sf_dir).select(
        "event_id",
        F.to_date(ts).alias("event_date"),
        F.date_sub(F.to_date(ts), 10).alias("ten_days_before"),
        c.seconds_before(ts, 90).alias("ninety_seconds_before"),
        F.date_trunc("minute", ts).alias("minute_ts"),
        F.date_trunc("hour", ts).alias("hour_ts"),
        c.seconds_between(c.instant("2024-01-01 00:00:00"), ts).alias("seconds_since"),
        c.hour_of_day(ts).alias("hour_of_day"),
        c.day_of_week(ts).alias("day_of_week"),
        c.minute_bucket(ts).alias("minute_bucket"),
        c.time_of_day(c.hour_of_day(ts), c.minute_bucket(ts)).alias("time_of_day"),
    )


@query(
    "f09_arithmetic_functions",
    "SELECT event_id, value / nullif(user_id, 0) AS ratio, CASE WHEN event_id % 4 > 0 THEN least(value, 50.0) END AS capped, "
    "CASE WHEN event_id % 4 > 0 THEN greatest(value, 50.0) END AS floored, "
    "value / sqrt(value ** 2 + user_id ** 2) AS power_factor, coalesce(CASE WHEN event_id % 4 > 0 THEN value END, 0) AS filled, "
    "CAST(round(CAST(value / 3 AS DECIMAL(28, 9)), 2) AS DOUBLE) AS rounded, "
    "value * tan(acos(CAST(0.85 AS DOUBLE) + (user_id % 15) / CAST(100 AS DOUBLE))) AS kvar FROM events",
    "ratio capped floored power_factor filled rounded kvar",
)
def arithmetic_functions(spark, sf_dir):
    value, user = F.col("value"), F.col("user_id")
    some = F.when(F.col("event_id") % 4 > 0, value)
    return events(spark, sf_dir).select(
        "event_id",
        c.safe_divide(value, user).alias("ratio"),
        c.strict_least(some, F.lit(50.0)).alias("capped"),
        c.strict_greatest(some, F.lit(50.0)).alias("floored"),
        c.power_factor(value, user.cast("double")).alias("power_factor"),
        F.coalesce(some, F.lit(0.0)).alias("filled"),
        c.round_stable(value / 3, 2).alias("rounded"),
        c.reactive_power(value, F.lit(0.85) + (user % 15) / F.lit(100.0)).alias("kvar"),
    )


@query(
    "f17_aggregate_functions",
    "SELECT event_type, quantile_disc(value, 0.1) AS p10, quantile_disc(value, 0.5) AS median, "
    "quantile_disc(value, 0.9) AS p90, stddev_samp(value) AS deviation, count(DISTINCT user_id) AS users, "
    "count(*) FILTER (value > 50) AS above_50 FROM events GROUP BY event_type",
    "p10 median p90 deviation",
)
def aggregate_functions(spark, sf_dir):
    rows = events(spark, sf_dir)
    quantiles = exact_quantiles(rows, ["event_type"], "value", {"p10": 0.1, "median": 0.5, "p90": 0.9})
    return (
        rows.groupBy("event_type")
        .agg(
            F.stddev("value").alias("deviation"),
            F.count_distinct("user_id").alias("users"),
            F.count_if(F.col("value") > 50).alias("above_50"),
        )
        .join(quantiles, "event_type")
        .select("event_type", "p10", "median", "p90", "deviation", "users", "above_50")
    )


@query(
    "f26_text_functions",
    "SELECT event_id, CAST(list_sum([CAST(trim(x) AS DOUBLE) FOR x IN string_split(concat(user_id, ' , ', value, ',0.5'), ',')]) AS DOUBLE) "
    "AS list_total, CAST(len(CASE WHEN value > 50 THEN ['high'] ELSE [] END) > 0 AS BOOLEAN) AS flagged, ts AS parsed_ts FROM events",
    "list_total",
)
def text_functions(spark, sf_dir):
    text = F.concat_ws(",", F.concat(F.col("user_id").cast("string"), F.lit(" ")),
                       F.concat(F.lit(" "), F.col("value").cast("string")), F.lit("0.5"))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return events(spark, sf_dir).select(
        "event_id",
        F.aggregate(c.float_list(text), F.lit(0.0), lambda a, x: a + x).alias("list_total"),
        (F.array_size(F.array_compact(F.array(F.when(F.col("value") > 50, "high")))) > 0).alias(
            "flagged"
        ),
        iso.try_cast("timestamp").alias("parsed_ts"),
    )
