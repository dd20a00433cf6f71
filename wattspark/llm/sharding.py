"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

How many rows of every input partition go to every shard is drawn first: row p of the matrix is a
multivariate hypergeometric draw of that partition's rows from the places that the shards have
left. Column sums are then the shard sizes, exactly. The draw has two levels, so that nobody holds the
matrix: the driver draws how many rows of each block of partitions go to each shard, and a task draws
the rows of its partition's block from the block's totals; blocks are as many as partitions in one. Each
partition permutes its rows and deals them out by its row of the matrix; after the exchange each
shard permutes what it received. Permutations are keyed bijections on 0 .. n-1, computed for a
row by itself, so nothing is gathered to be shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattspark.llm.common import column, scrambled, written

INDEX_BITS = 33  # of a row's number in its partition, as monotonically_increasing_id lays it out


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Image of each index under a keyed permutation of 0 .. n-1.

    A Feistel network of six rounds on the next even number of bits; values outside are sent
    through again until they fall inside.
    """
    if n <= 1:
        return np.zeros(len(index), np.int64)
    half = np.uint64((max(2, int(n - 1).bit_length()) + 1) // 2)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for i in range(6):
            salt = np.uint64(((key << 3) + i) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            left, right = right, left ^ (scrambled(right ^ salt) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


def hypergeometric(good: int, bad: int, draws: int, rng: np.random.Generator) -> int:
    """Number of good among ``draws`` without replacement; exact at any size."""
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws)) if good and draws else 0
    if not good or not draws:
        return 0
    low, high = max(0, draws - bad), min(good, draws)
    mode = min(max((draws + 1) * (good + 1) // (good + bad + 2), low), high)
    wide = int(20 + 12 * (draws * (good / (good + bad)) * (bad / (good + bad)) + 1) ** 0.5)
    k = np.arange(max(low, mode - wide), min(high, mode + wide) + 1, dtype=np.float64)
    ratio = np.log((good - k[:-1]) * (draws - k[:-1])) - np.log((k[:-1] + 1) * (bad - draws + k[:-1] + 1))
    log_p = np.concatenate([[0.0], np.cumsum(ratio)])
    p = np.exp(log_p - log_p.max())
    return int(k[np.searchsorted(np.cumsum(p), rng.random() * p.sum())])


def communication_matrix(rows: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """Rows of each partition (first index) that go to each shard (second index)."""
    rng = np.random.default_rng(seed)
    left = [int(x) for x in sizes]
    out = np.zeros((len(rows), len(sizes)), np.int64)
    for p, n in enumerate(rows.tolist()):
        others, need = sum(left), int(n)
        for s, room in enumerate(left):
            others -= room
            got = hypergeometric(room, others, need, rng)
            out[p, s] = got
            left[s] -= got
            need -= got
    return out


def block_width(parts: int) -> int:
    """Partitions in a block."""
    return max(1, math.isqrt(max(parts - 1, 0)) + 1)


def block_totals(rows: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """Rows of each block of partitions that go to each shard."""
    starts = np.arange(0, len(rows), block_width(len(rows)))
    in_block = np.add.reduceat(rows, starts) if len(rows) else rows
    return communication_matrix(in_block, sizes, seed)


def block_matrix(rows: np.ndarray, totals: np.ndarray, block: int, seed: int) -> np.ndarray:
    """The matrix's rows for the partitions of one block, whose columns add up to the block's totals."""
    width = block_width(len(rows))
    return communication_matrix(rows[block * width : (block + 1) * width], totals[block], seed * 1_000_003 + block + 1)


def shard_sizes(n: int, shards: int, seed: int) -> np.ndarray:
    """Near-equal sizes; which shards get one more is drawn."""
    out = np.full(shards, n // shards, np.int64)
    extra = np.random.default_rng(seed + 1).permutation(shards)[: n % shards]
    out[extra] += 1
    return out


def shuffle_to_shards(
    df: DataFrame, shards: int, seed: int = 0, rows_per_file: int = 50_000, exchange: bool = True
) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (0 .. shards-1) and ``slot`` (0 .. size-1, gapless).

    Sizes differ by at most one row. Rows are numbered by where they are, not by what they hold:
    equal rows, nulls and long texts need no care, and no key decides. Columns named ``shard`` or
    ``slot`` are replaced; an empty table gives no rows.

    The rows are written to the scratch folder once, with the number of their partition and their
    place in it. All that follows is a function of these two, so a task that runs again gives the
    same rows the same places. Counts per partition come to the driver, and the matrix goes to the
    tasks: 8 bytes per partition and shard. With ``exchange``, rows are laid out by shard and
    slot, in pieces of ``rows_per_file``.
    """
    names = {f"c{i}": c for i, c in enumerate(df.columns) if c not in ("shard", "slot")}
    at = F.monotonically_increasing_id()
    fixed = written(df.select(*(column(c).alias(a) for a, c in names.items()), at.alias("at")), "to_shard")
    part = F.shiftright("at", INDEX_BITS)
    counts = {r["p"]: r["n"] for r in fixed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    parts = np.array(sorted(counts), np.int64)
    rows = np.array([counts[p] for p in parts.tolist()], np.int64)
    sizes = shard_sizes(int(rows.sum()), shards, seed)
    sent = df.sparkSession.sparkContext.broadcast((parts, rows, block_totals(rows, sizes, seed), sizes))
    schema = fixed.drop("at").schema.add("shard", "integer").add("slot", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, rows, totals, sizes = sent.value
        width = block_width(len(rows))
        drawn = -1
        for batch in batches:
            at = batch.column(batch.num_columns - 1).to_numpy()
            where = np.searchsorted(parts, at >> INDEX_BITS)
            shard = np.zeros(len(at), np.int64)
            slot = np.zeros(len(at), np.int64)
            for p in np.unique(where).tolist():
                mine = np.flatnonzero(where == p)
                index = at[mine] & ((1 << INDEX_BITS) - 1)
                local = permuted(index, int(rows[p]), seed * 2_000_003 + 2 * int(parts[p]))
                if p // width != drawn:
                    drawn = p // width
                    matrix = block_matrix(rows, totals, drawn, seed)
                    upto = np.cumsum(matrix, axis=1)  # within a partition
                    before = np.cumsum(matrix, axis=0) - matrix + totals[:drawn].sum(axis=0)  # within a shard
                q = p % width
                to = np.searchsorted(upto[q], local, side="right")
                shard[mine] = to
                slot[mine] = before[q, to] + local - (upto[q, to] - matrix[q, to])
            for s in np.unique(shard).tolist():
                mine = shard == s
                slot[mine] = permuted(slot[mine], int(sizes[s]), seed * 2_000_003 + 2 * s + 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(shard.astype(np.int32)), pa.array(slot)],
                [*names, "shard", "slot"],
            )

    out = fixed.mapInArrow(run, schema)
    if exchange:
        piece = F.floor(F.col("slot") / F.lit(rows_per_file))
        out = out.repartition("shard", piece).sortWithinPartitions("shard", "slot")
    return out.select(*(F.col(a).alias(c) for a, c in names.items()), "shard", "slot")
