"""Benchmark decontamination: size-partitioned MinHash containment search.

A document leaks a test item if it holds at least ``containment`` of the item's distinct
``words_per_shingle``-word shingles. Test items are short and documents long, so a resemblance
sketch of whole documents would not see them; containment is searched instead:

- Items are partitioned by size (number of distinct shingles, classes of powers of two). An item
  of n shingles may miss at most n - ceil(containment * n) of them, so of its k smallest hashes,
  k one above that number, a leaking document has at least one. k is set per size class, from the
  largest size of the class. These k hashes are the item's MinHash sketch: no leak is lost.
- Documents are read once. Whole texts are shingled, and only shingles whose bit is set in a bit
  map of the items' shingles go on; the map has a fixed size, whatever the number of items.
- A document and an item that share a sketch shingle are a candidate; it is verified by exact
  containment on the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from wattspark.llm.common import PLAIN, bit_map, bytes_of, grams, hashes, in_map, written

WORDS = 5
CONTAINMENT = 0.8
FILTER_BITS = 1 << 24


def shingles(text: bytes, k: int = WORDS) -> tuple[list[bytes], np.ndarray]:
    """Words of a text and the hash of each of its shingles.

    Words are runs of letters and digits, A-Z lower-cased; a text of fewer than ``k`` words has
    one shingle, all of them; one without words has none.
    """
    words = text.translate(PLAIN).split()
    k = min(k, len(words))
    return words, grams(hashes(words, len(words)), k) if k else np.empty(0, np.uint64)


def _item_shingles(items: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found, codes = [], [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words, h = shingles(text, k)
                size = min(k, len(words))
                seen = {}
                for i, code in enumerate(h.tolist()):
                    seen.setdefault(b" ".join(words[i : i + size]), code)
                ids += [item] * len(seen)
                found += seen
                codes += seen.values()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(found, pa.binary()).cast(pa.string()),
                    pa.array(np.array(codes, np.uint64).view(np.int64)),
                ],
                ["item_id", "shingle", "code"],
            )

    rows = items.select(F.col("item_id").cast("long").alias("item_id"), bytes_of(F.col("text")).alias("text"))
    found = rows.where("item_id IS NOT NULL").mapInArrow(run, "item_id long, shingle string, code long")
    return found.distinct()


def sketched(items: DataFrame, k: int = WORDS, containment: float = CONTAINMENT) -> DataFrame:
    """``(item_id, shingle, code, n, in_sketch)``: the items' shingles and which are MinHash values."""
    found = _item_shingles(items, k)
    per_item = Window.partitionBy("item_id")
    found = found.withColumn("n", F.count("*").over(per_item)).withColumn(
        "rank", F.row_number().over(per_item.orderBy("code", "shingle"))
    )
    largest = F.pow(F.lit(2.0), F.length(F.bin("n"))) - 1  # of the size class
    kept = largest - F.ceil(F.lit(containment) * largest - F.lit(1e-9)) + 1
    return found.withColumn("in_sketch", F.col("rank") <= kept).drop("rank")


def leaks(
    docs: DataFrame,
    items: DataFrame,
    words_per_shingle: int = WORDS,
    containment: float = CONTAINMENT,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``(doc_id, item_id, n_shingles, n_shared, containment)``: one row per leak.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``; other columns are
    not read. Items without words, null texts and null ids take no part; an item of fewer words
    than a shingle is one shingle, met only by documents of exactly those words. Rows that repeat
    an id are one document, and their shingles count together; an empty table on either side gives no rows.
    """
    k = words_per_shingle
    known = written(sketched(items, k, containment), "items")
    sent = docs.sparkSession.sparkContext.broadcast(
        (bit_map(known, "code", filter_bits), bit_map(known.where("in_sketch"), "code", filter_bits))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, sketch = sent.value
        for batch in batches:
            ids, probes, found = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words, h = shingles(text, k)
                hit = np.flatnonzero(in_map(h, every))
                if not len(hit):
                    continue
                size = min(k, len(words))
                show = lambda at: list({b" ".join(words[i : i + size]) for i in at.tolist()})  # noqa: B023, E731
                ids.append(doc)
                probes.append(show(hit[in_map(h[hit], sketch)]))
                found.append(show(hit))
            lists = pa.list_(pa.binary())
            strings = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(probes, lists).cast(strings),
                    pa.array(found, lists).cast(strings),
                ],
                ["doc_id", "probes", "found"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), bytes_of(F.col("text")).alias("text"))
    met = written(
        rows.where("doc_id IS NOT NULL").mapInArrow(
            run, "doc_id long, probes array<string>, found array<string>"
        ),
        "met",
    )
    probes = met.select("doc_id", F.explode("probes").alias("shingle")).distinct()
    sketch = known.where("in_sketch").select("item_id", "shingle")
    candidates = probes.join(sketch, "shingle").select("doc_id", "item_id").distinct()
    whole = known.groupBy("item_id").agg(F.collect_list("shingle").alias("wanted"))
    # rows that repeat an id are one document
    seen = met.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("found"))).alias("found"))
    shared = F.size(F.array_intersect("wanted", "found")).cast("long")
    verified = candidates.join(seen, "doc_id").join(whole, "item_id")
    verified = verified.select(
        "doc_id", "item_id", F.size("wanted").cast("long").alias("n_shingles"), shared.alias("n_shared")
    )
    share = F.col("n_shared") / F.col("n_shingles")
    return verified.where(F.col("n_shared") >= F.lit(containment) * F.col("n_shingles") - 1e-9).withColumn(
        "containment", share
    )
