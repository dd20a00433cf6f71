"""Ordered calculations per key that never put an unbounded key into one task.

A window partitioned by ``meter_id`` alone puts all rows of a meter into one task, however many
there are. Every key is therefore cut into time slices: windows run within ``(key, slice)``, one
small row per slice carries totals forward, and the totals are joined back on the same hash
partitioning, so the rows are shuffled once. There is one plan for every size. Results are those of
a plain window for every slice length, also for NULL keys, which form a key of their own.

``slice_seconds`` bounds a task: the default of a day holds at most 86,400 readings of a meter that
reports once a second. What runs per key without a slice sees one or two rows per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SLICE = "_slice"
KEY = "_key"
DAY = 86_400


def time_slice(ts: str, seconds: int) -> Column:
    if seconds < 1:
        raise ValueError("slice_seconds must be at least 1")
    return F.floor(F.unix_seconds(F.col(ts)) / F.lit(seconds)).cast("long")


def _key(keys: Sequence[str]) -> Column:
    """The key as one value that is never NULL, so that it joins where its parts are.

    Without keys all rows are one key; callers do that only with a row per day or less.
    """
    return F.struct(*[F.col(k) for k in keys]) if keys else F.lit(0)


def with_running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    totals: dict[str, tuple[str, Column]],
    slice_seconds: int = DAY,
    inclusive: bool = True,
) -> DataFrame:
    """Add running aggregates over ``order`` (first entry: the time column).

    ``totals`` maps the new column to ``("sum" | "max", column)``. With
    ``inclusive=False`` the current row is left out, so a maximum is NULL and a
    sum 0 on the first row of a key.
    """
    agg = {"sum": F.sum, "max": F.max}
    sliced = df.withColumns({SLICE: time_slice(order[0], slice_seconds), KEY: _key(keys)})
    within = Window.partitionBy(KEY, SLICE).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow if inclusive else -1
    )
    local = sliced.withColumns(
        {f"_l_{name}": agg[kind](col).over(within) for name, (kind, col) in totals.items()}
    )
    before = Window.partitionBy(KEY).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        sliced.groupBy(KEY, SLICE)
        .agg(*[agg[kind](col).alias(f"_c_{name}") for name, (kind, col) in totals.items()])
        .select(
            KEY,
            # a row without a time is in no slice, which has to join like any other
            F.coalesce(F.col(SLICE), F.lit(-(1 << 62))).alias(SLICE),
            *[agg[kind](f"_c_{name}").over(before).alias(f"_c_{name}") for name, (kind, _) in totals.items()],
        )
    )
    local = local.withColumn(SLICE, F.coalesce(F.col(SLICE), F.lit(-(1 << 62))))
    joined = local.join(carried, [KEY, SLICE], "left")

    def merged(name: str, kind: str) -> Column:
        here = F.col(f"_l_{name}")
        if kind == "max":
            return F.greatest(here, F.col(f"_c_{name}"))
        return F.coalesce(here, F.lit(0)) + F.coalesce(f"_c_{name}", F.lit(0))

    return joined.select(
        *df.columns, *[merged(name, kind).alias(name) for name, (kind, _) in totals.items()]
    )


def consecutive_pairs(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[str],
    slice_seconds: int = DAY,
) -> DataFrame:
    """Every row of a key next to the row before it, as ``prev_<column>``.

    The first row of a key has no predecessor and is not returned.
    """
    wanted = list(dict.fromkeys([*order, *columns]))
    sliced = df.select(
        *keys, *wanted, time_slice(order[0], slice_seconds).alias(SLICE), _key(keys).alias(KEY)
    )
    within = Window.partitionBy(KEY, SLICE).orderBy(*order)
    record = F.struct(*wanted)
    marked = sliced.withColumns(
        {
            "_prev": F.lag(record).over(within),
            "_is_last": F.lead(F.lit(1)).over(within).isNull(),
        }
    )

    def as_pairs(pairs: DataFrame) -> DataFrame:
        return pairs.select(
            *keys,
            *[F.col(c) for c in wanted],
            *[F.col(f"_prev.{c}").alias(f"prev_{c}") for c in wanted],
        )

    inner = as_pairs(marked.filter(F.col("_prev").isNotNull()))
    # At most two rows per slice reach this window: the first and the last.
    edges = marked.filter(F.col("_prev").isNull() | F.col("_is_last")).drop("_prev")
    along = Window.partitionBy(KEY).orderBy(*order)
    seams = edges.withColumns(
        {"_prev": F.lag(record).over(along), "_prev_slice": F.lag(SLICE).over(along)}
    ).filter(F.col("_prev").isNotNull() & ~F.col("_prev_slice").eqNullSafe(F.col(SLICE)))
    return inner.unionByName(as_pairs(seams))


def with_trailing_count(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    condition: Column,
    seconds: int,
    name: str,
    slice_seconds: int = DAY,
) -> DataFrame:
    """Rows meeting ``condition`` within the trailing range ``[ts - seconds, ts]``.

    Rows near the end of a slice are copied into the next one as context. A
    slice is at least four times the range: one copy at most.
    """
    width = max(slice_seconds, 4 * seconds)
    reach = F.floor((F.unix_seconds(F.col(ts)) + seconds) / F.lit(width)).cast("long")
    marked = df.withColumns(
        {
            KEY: _key(keys),
            "_home": F.coalesce(time_slice(ts, width), F.lit(-(1 << 62))),
            "_hit": condition.cast("int"),
            "_us": F.unix_micros(F.col(ts)),
        }
    )
    slices = F.sequence(F.col("_home"), F.coalesce(reach, F.col("_home")))
    marked = marked.withColumn(SLICE, F.explode(slices))
    trailing = (
        Window.partitionBy(KEY, SLICE).orderBy("_us").rangeBetween(-seconds * 1_000_000, 0)
    )
    counted = marked.withColumn(name, F.coalesce(F.sum("_hit").over(trailing), F.lit(0)).cast("long"))
    return counted.filter(F.col(SLICE) == F.col("_home")).select(*df.columns, name)
