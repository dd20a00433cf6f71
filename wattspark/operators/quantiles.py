"""Exact quantiles per group, by counting instead of collecting values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

DIGIT_BITS = 16
DIGITS = 3


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """Per group, the smallest value that at least a share ``p`` of the values does not exceed.

    ``probabilities`` maps the new column to ``p``. Equal values are counted before they are shuffled.
    Their places in the group's range are numbers of 48 bits, of which each step settles the next 16
    for every quantile: it counts the values of the part found so far by their next digit and takes
    the digit in which the rank falls. A task so orders at most 65,536 counts of a group and quantile,
    whatever the range and the number of values; only values that share all 48 bits are ordered at last
    themselves. NULL, NaN and infinite values are left out; NULL keys are a group.
    """
    number = F.col(value).cast("double")
    counted = (
        df.where(number.isNotNull() & ~F.isnan(number) & (F.abs(number) < F.lit(float("inf"))))
        .groupBy(F.struct(*keys).alias("_g"), F.col(value).alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    span = counted.groupBy("_g").agg(
        F.sum("_n").alias("_all"), F.min("_v").cast("double").alias("_low"), F.max("_v").cast("double").alias("_high")
    )
    ranks = [
        F.struct(F.lit(name).alias("_name"), F.ceil(F.lit(p) * F.col("_all") - F.lit(1e-9)).alias("_rank"))
        for name, p in probabilities.items()
    ]
    zero = F.lit(0).cast("long")
    sought = span.withColumn("_s", F.explode(F.array(*ranks))).select(
        "_g", "_low", "_high", "_s._name", F.greatest(F.col("_s._rank"), F.lit(1)).alias("_rank"),
        zero.alias("_found"), zero.alias("_before"),
    )
    bits = DIGIT_BITS * DIGITS
    # halves, so that the widest range does not overflow; every step keeps the order of the values
    width = F.col("_high") / 2 - F.col("_low") / 2
    part = (F.col("_v").cast("double") / 2 - F.col("_low") / 2) / width
    place = F.when(width > 0, F.least(F.floor(part * F.lit(float(1 << bits))), F.lit((1 << bits) - 1))).otherwise(zero)
    one = ("_g", "_name")
    for step in range(DIGITS):
        left = bits - DIGIT_BITS * step
        inside = counted.join(sought, "_g").withColumn("_place", place)
        inside = inside.where(F.shiftright("_place", left) == F.col("_found"))
        digit = F.shiftright("_place", left - DIGIT_BITS).alias("_digit")
        carried = ("_low", "_high", "_rank", "_before")
        sums = inside.groupBy(*one, *carried, digit).agg(F.sum("_n").alias("_in"))
        upto = F.col("_before") + F.sum("_in").over(Window.partitionBy(*one).orderBy("_digit"))
        sums = sums.withColumn("_upto", upto).where("_upto >= _rank AND _upto - _in < _rank")
        sought = sums.select(
            *one, "_low", "_high", "_rank", F.col("_digit").alias("_found"), (F.col("_upto") - F.col("_in")).alias("_before")
        )
    same = counted.join(sought, "_g").where(place == F.col("_found"))
    upto = F.col("_before") + F.sum("_n").over(Window.partitionBy(*one).orderBy("_v"))
    reached = same.withColumn("_upto", upto).where("_upto >= _rank")
    return (
        reached.groupBy("_g")
        .agg(*[F.min(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in probabilities])
        .select(*[F.col(f"_g.{k}").alias(k) for k in keys], *probabilities)
    )
