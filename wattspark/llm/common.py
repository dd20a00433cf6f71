"""What the operators of this folder share: scratch tables, words, hashes and bounded bit maps."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wattspark.session import scratch_dir

# Letters A-Z to a-z; other bytes, those of longer characters included, stay.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# ASCII letters (lower-cased) and digits stay, bytes of longer characters stay, the rest are blanks.
PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder: computed once, lineage cut."""
    spark = df.sparkSession
    path = scratch_dir(spark, re.sub(r"\W+", "_", name))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def column(name: str) -> Column:
    """The column of that name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(name: str, columns: Iterable[str]) -> str:
    """``name``, made longer until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def gathered(batches: Iterable[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about ``size`` bytes of a column, at least a row each; nulls have none."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 50):
            held.append(batch.slice(at, 50))
            total += pc.sum(pc.binary_length(held[-1].column(column))).as_py() or 0
            if total >= size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, total = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def bytes_of(text: Column) -> Column:
    """UTF-8 bytes of a text, empty for null."""
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def hashes(words: Iterable[bytes], n: int) -> np.ndarray:
    """64-bit hash of every word."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)


def scrambled(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (multiply and shift)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def grams(symbols: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` symbols, order counted; empty below ``k`` symbols."""
    n = len(symbols) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += symbols[i : i + n]
    return scrambled(out)


def bit_map(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bit map with the bit ``key mod bits`` set for each key; ``bits`` is a power of two.

    At most ``bits / 8`` bytes reach the driver, whatever the number of keys: the keys are
    merged into blocks of 32,768 bits by an aggregate.
    """
    place = F.pmod(F.col(column), F.lit(bits))
    blocks = (
        keys.select(place.alias("p"))
        .groupBy(F.expr("bitmap_bucket_number(p + 1)").alias("b"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(p + 1))").alias("m"))
    )
    out = np.zeros(bits // 8, np.uint8)
    for row in blocks.toLocalIterator():
        at = (row["b"] - 1) * 4096
        part = np.frombuffer(row["m"], np.uint8)
        out[at : at + len(part)] = part[: len(out) - at]
    return out


def in_map(values: np.ndarray, bit_map: np.ndarray) -> np.ndarray:
    """Which values have their bit set."""
    place = values & np.uint64(len(bit_map) * 8 - 1)
    return (bit_map[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
