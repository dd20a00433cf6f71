"""Connected components by star contraction, as joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wattspark.llm.common import written


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(u, v)``; ``root`` is the smallest node reachable.

    Each round ties the larger neighbours of every node to its smallest neighbour (large star),
    then all smaller neighbours to the smallest (small star). Components become stars after a
    number of rounds that grows with the logarithm of their size. Minima are aggregated before
    they are shuffled and come back by a join that adaptive execution can split, so a hub is
    never gathered in one task. Rounds are written to the scratch folder; only counts reach the
    driver. Self-links and repeated links do no harm; without edges there are no rows.
    """
    u, v = F.col("u"), F.col("v")
    now = written(
        edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), "edges"
    )
    state = None
    while True:
        after = _round(now)
        after = written(after, "edges")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark[0] == 0 or mark == state:
            return after.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                after.select("v", "v").distinct()
            )
        now, state = after, mark


def _round(edges: DataFrame) -> DataFrame:
    """One large star and one small star over edges whose ``u`` is above ``v``."""
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u != v").distinct()
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.union(least.select("u", F.col("m").alias("v"))).distinct()
