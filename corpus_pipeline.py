"""From raw documents to shuffled shards of a clean mix: five stages, each an operator of ``wattspark.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; what it returns is written as
Parquet and read again as the next one's documents. Nulls, empty and very long texts, repeated
rows and further columns are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattspark.llm import decontaminate, langid, mixing, queries, sharding, simhash
from wattspark.llm.common import column, table, unused, written

SHARDS = 24
MAX_REPEATS = 2.0


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; rejected are those without letters and those whose
    confidence is below the calibrated threshold. A null ``doc_id`` is no obstacle."""
    columns = docs.columns
    named = docs.select(*(column(c).alias(f"_{i}") for i, c in enumerate(columns)), F.col("text").alias("text"))
    told = langid.identify(named, queries.language_model(docs))
    return told.where(~F.col("rejected")).select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(columns)))


def told_apart(rows: DataFrame, key: str) -> tuple[DataFrame, str]:
    """The rows with one more column, and its name: a number that no two rows share and none lacks.
    It is ``key`` where that is unique and never null, else a row number fixed by a written copy."""
    name = unused("_row", rows.columns)
    number = column(key).cast("long")
    again = rows.groupBy(number.alias("_key")).agg(F.count("*").alias("n")).where("n > 1 OR _key IS NULL")
    if again.isEmpty():
        return rows.withColumn(name, number), name
    return written(rows.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, whatever the ids: rows that repeat an id or have none are
    judged each on its own text. The row of the smallest id stands for its group, one without an id only
    where no row has one; the row number decides between equal ids."""
    rows, row = told_apart(docs, "doc_id")
    groups = simhash.near_duplicates(rows.select(column(row).alias("doc_id"), "text"))
    ids = rows.select(column(row).alias("_row"), F.col("doc_id").cast("long").alias("_id"))
    # merged at any size: ids grow with the documents, so a broadcast would only be right for small ones
    groups = groups.join(ids.hint("merge"), F.col("doc_id") == F.col("_row"))
    first = groups.groupBy("component_id").agg(F.min(F.struct(F.col("_id").isNull(), "_id", "_row")).alias("first"))
    name = unused("_id", rows.columns)
    chosen = written(first.select(F.col("first._row").alias(name)), "chosen")
    return rows.join(chosen.hint("merge"), column(row) == F.col(name), "left_semi").drop(row)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item: every row is searched for every item, each on its own
    text, whether their ids are null, repeated or neither."""
    rows, row = told_apart(docs, "doc_id")
    items, item = told_apart(table(spark, sf_dir, "benchmark"), "item_id")
    found = decontaminate.leaks(
        rows.select(column(row).alias("doc_id"), "text"), items.select(column(item).alias("item_id"), "text")
    )
    name = unused("_id", rows.columns)
    leaked = written(found.select(F.col("doc_id").alias(name)).distinct(), "leaked")
    return rows.join(leaked, column(row) == F.col(name), "left_anti").drop(row)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources flattened until the smallest is read twice as often as the largest; the budget is the
    least under which each document comes at least once. Columns with the names of those that mixing
    adds keep their values."""
    read = ("doc_id", "text", "source")
    names = {c: c if c in read else f"_{i}" for i, c in enumerate(docs.columns)}
    named = docs.select(*(column(c).alias(n) for c, n in names.items()))
    rows = mixing.mix(named, max_repeats=MAX_REPEATS, seed=11)
    return rows.select(*(F.col(n).alias(c) for c, n in names.items()))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, uniformly shuffled, with ``shard`` and ``slot``."""
    return sharding.shuffle_to_shards(docs, SHARDS, seed=20)


STAGES = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("source_mixing", mixed),
    ("sharding", sharded),
]

# A trained classifier, XXH64 fingerprints and drawn places are beyond SQL; tests compare with
# brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
