"""SimHash near-duplicates by multi-index hashing.

Every document gets a 64-bit fingerprint. Fingerprints that differ in at most ``distance`` bits
are linked; documents fall into the connected components of these links.

A fingerprint is cut into two segments of 32 bits. If two fingerprints differ in at most three
bits, one segment differs in at most one. Each distinct fingerprint is filed under both its
segments, looks up the Hamming ball of radius ``distance // 2`` around each, and what the lookup
fetches is verified on all 64 bits. As links have no direction, a lookup need only set bits that
are 0, for the other side has them set, which halves the balls.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from wattspark.llm.common import LOWER, bytes_of, written
from wattspark.llm.components import connected

SEED = 42  # of the shingle hash


def simhash(text: bytes, words_per_shingle: int = 3) -> int:
    """Fingerprint of one text: a bit is set if it is set in over half the shingle hashes.

    Shingles are runs of lower-cased words joined by one blank, repeats included. A text of
    fewer words has one shingle, the whole sequence; a text without words has fingerprint 0.
    """
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= words_per_shingle:
        found = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        after = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = [0, *after[:-words_per_shingle].tolist()]
        ends = (after[words_per_shingle - 1 :] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        found = [digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)]
    return _majority(np.array(found, np.uint64))


def _majority(found: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(found), 4096):
        part = found[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(found), bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words_per_shingle: int = 3
) -> DataFrame:
    """``(doc_id, fp)`` of every row, ``fp`` the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [simhash(t, words_per_shingle) for t in batch.column(1).to_pylist()]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fps], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), bytes_of(F.col(text_col)).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _segments(fp: Column) -> tuple[Column, Column]:
    return fp.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(fp, 32)


def _ball(segment: Column, radius: int) -> Column:
    """The segment, and all values with up to ``radius`` more bits set."""
    ball = F.array(segment)
    for _ in range(radius):
        ball = F.array_distinct(
            F.flatten(
                F.transform(
                    ball,
                    lambda s: F.transform(F.sequence(F.lit(0), F.lit(31)), lambda b: _with_bit(s, b)),
                )
            )
        )
        ball = F.array_distinct(F.concat(F.array(segment), ball))
    return ball


def _with_bit(s: Column, b: Column) -> Column:
    return s.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))


def links(distinct: DataFrame, distance: int = 3) -> DataFrame:
    """``(u, v)``: every pair of the distinct fingerprints ``fp`` within ``distance`` bits, once.

    Complete for a distance up to 3: of two segments, one differs in at most one bit, and the
    side whose bit is 0 finds the other. The segments and their number go into the key.
    """
    if not 0 <= distance <= 3:
        raise ValueError("two segments with one-sided balls of radius 1 cover distances 0 to 3")
    fp = F.col("fp")
    low, high = _segments(fp)
    tag = F.lit(1 << 32)
    filed = distinct.select(fp.alias("v"), F.explode(F.array(low, high.bitwiseOR(tag))).alias("key"))
    radius = distance // 2
    looked = distinct.select(
        fp.alias("u"),
        F.explode(
            F.concat(_ball(low, radius), F.transform(_ball(high, radius), lambda x: x.bitwiseOR(tag)))
        ).alias("key"),
    )
    u, v, key = F.col("u"), F.col("v"), F.col("key")
    apart = F.bit_count(u.bitwiseXOR(v))
    own = F.when(key >= F.lit(1 << 32), F.shiftrightunsigned(u, 32).bitwiseOR(tag)).otherwise(
        u.bitwiseAND(F.lit(0xFFFFFFFF))
    )
    # met on equal segments by both sides: keep one of the two
    once = (own != key) | (u < v)
    # met on the low segment already: not again on the high one
    first = (key < F.lit(1 << 32)) | (
        F.bit_count(u.bitwiseXOR(v).bitwiseAND(F.lit(0xFFFFFFFF))) > F.lit(radius)
    )
    return looked.join(filed, "key").where((u != v) & (apart <= distance) & once & first).select("u", "v")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words_per_shingle: int = 3,
    distance: int = 3,
) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest id among all documents reachable over links, the document
    itself included. Null and empty texts have fingerprint 0 and are linked like any other.
    Rows that repeat an id each keep their row; a null id gets its component but is no
    component's name, unless all ids there are null: then that is null. Other columns are not
    read, so their names may clash. An empty table gives no rows.

    Copies collapse into one fingerprint before anything is joined.
    """
    prints = written(fingerprints(docs, id_col, text_col, words_per_shingle), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    tied = connected(links(distinct.select("fp"), distance))
    classes = distinct.join(tied, distinct["fp"] == tied["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("class")
    )
    named = classes.groupBy("class").agg(F.min("least").alias("component_id"))
    by_print = classes.join(named, "class").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(by_print, F.col("fp") == F.col("_fp")).select("doc_id", "fp", "component_id")
