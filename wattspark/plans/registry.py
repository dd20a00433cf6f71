"""Registration of queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wattspark.plans.projections import FLEET_SQL, MESSAGES_SQL, READINGS_SQL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Shown digits. Summation noise is rounded off first, so exact halves do not depend on the order
# of adding up.
DIGITS = 6
CLEAN = 9
# DuckDB rounds binary values, Spark decimal ones. The nudge, in the SQL only, decides exact halves
# away from zero, as Spark does.
NUDGE = "2e-10"


def tidy(df: DataFrame) -> DataFrame:
    """Stable output types: rounded doubles, long integers, zone-free times, joined lists."""
    columns = []
    for field in df.schema:
        col = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            col = F.round(F.round(col, CLEAN), DIGITS) + F.lit(0.0)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            col = col.cast("long")
        elif isinstance(field.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType):
            col = F.array_join(col, ",")
        columns.append(col.alias(field.name))
    return df.select(*columns)


def oracle(body: str, doubles: str = "", *ctes: str) -> str:
    """``body`` over the projection CTEs, with the named columns rounded like ``tidy`` does."""
    known = (("readings", READINGS_SQL), ("messages", MESSAGES_SQL), ("fleet", FLEET_SQL))
    used = [sql for name, sql in known if name in body or any(name in c for c in ctes)]
    prefix = "WITH " + ",\n".join([*used, *ctes]) + "\n" if used or ctes else ""
    if not doubles:
        return prefix + body
    shown = "round(round({c}, {clean}) + sign({c}) * {nudge}, {digits}) + 0.0 AS {c}"
    rounded = ", ".join(shown.format(c=c, clean=CLEAN, nudge=NUDGE, digits=DIGITS) for c in doubles.split())
    return f"{prefix}SELECT * REPLACE ({rounded}) FROM (\n{body}\n) AS answer"


def query(name: str, sql: str | None = None, doubles: str = "", ctes: tuple = ()):
    """Register a query under ``name``, with its SQL where SQL can express it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"registered twice: {name}")
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = oracle(sql, doubles, *ctes)
        return fn

    return register
