"""Merkle manifest of a table, kept in a van Emde Boas layout.

Rows are leaves. Neighbouring nodes of a level form runs of ``FAN``; the digest of a run is a node of
the next level, until one node is left. The leaves of a source make a tree whose last node is the
source's subroot, and the subroots make the tree of the root.

The runs form a tree as well, and that is what is stored: a tree of runs is split at half its height,
the lower half rounded to a power of two, into one top and equal, aligned bottoms that follow it, each
laid out the same way. ``address`` finds a run's place by arithmetic alone; a run's nodes are
neighbours, so the siblings of a node are one slice. The layout holds for blocks of any size. Here a
block is a subtree of ``HEIGHT`` levels of runs, one row of a table; blocks are built where their nodes
are, and the roots of blocks are the nodes of the next, smaller table of blocks. No step gathers more
than a block's ``FAN ** HEIGHT`` nodes in one place, however many rows a source has.

Proofs go the other way: what stands above a block's root is handed down, and each block adds the
siblings within it.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from wattspark.llm.common import column, written

FAN = 16
HEIGHT = 2  # a power of two, so that blocks are whole subtrees of the layout
DIGEST = 32


def runs_of(height: int) -> int:
    """Runs of a full tree of so many levels."""
    return (FAN**height - 1) // (FAN - 1)


def height_of(nodes: int) -> int:
    """Levels of runs above so many nodes."""
    height = 0
    while nodes > 1:
        nodes, height = -(-nodes // FAN), height + 1
    return height


@functools.cache
def address(height: int, depth: int, index: int) -> int:
    """Place of the ``index``-th of the runs that are ``depth`` below the top of a tree of runs."""
    if height == 1:
        return 0
    bottom = 1 << ((height - 1).bit_length() - 1)
    top = height - bottom
    if depth < top:
        return address(top, depth, index)
    below = FAN ** (depth - top)
    return runs_of(top) + index // below * runs_of(bottom) + address(bottom, depth - top, index % below)


def digest(nodes: bytes) -> bytes:
    """Digest of a run: of its nodes' digests as hex text, one after another."""
    return hashlib.sha256(nodes.hex().encode()).digest()


def laid_out(nodes: list[bytes], height: int) -> tuple[bytes, bytes]:
    """A block over these nodes, and its root."""
    block, width = bytearray(runs_of(height) * FAN * DIGEST), FAN * DIGEST
    for depth in reversed(range(height)):
        above = []
        for i in range(0, len(nodes), FAN):
            run = b"".join(nodes[i : i + FAN])
            at = address(height, depth, i // FAN) * width
            block[at : at + len(run)] = run
            above.append(digest(run))
        nodes = above
    return bytes(block), nodes[0]


def siblings(block: bytes, height: int, nodes: int, at: int) -> tuple[list[str], list[str]]:
    """The digests, as hex text, left and right of the path from node ``at`` of a block, level by level."""
    lefts, rights = [], []
    for depth in reversed(range(height)):
        run, slot = divmod(at, FAN)
        start = address(height, depth, run) * FAN * DIGEST
        end = start + min(FAN, nodes - run * FAN) * DIGEST
        here = start + slot * DIGEST
        lefts.append(block[start:here].hex())
        rights.append(block[here + DIGEST : end].hex())
        at, nodes = run, -(-nodes // FAN)
    return lefts, rights


def leaf(*values: Column) -> Column:
    """Hex digest of a row's values: each as ``-`` if null, else as byte count, colon and text."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos``, the place within its tree by ``order``, and ``n``, the rows of the tree.

    ``order`` must tell all rows of a tree apart. Rows are sorted by ranges and counted per range, so
    a tree may have any number of them.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    ranged = written(ranged.withColumn("_m", F.monotonically_increasing_id()), name)
    part = F.shiftright("_m", 33)
    counts = ranged.groupBy("tree", part.alias("_part")).agg(F.count("*").alias("_k"), F.min("_m").alias("_least"))
    tree = Window.partitionBy("tree")
    before = F.sum("_k").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    first = F.coalesce(before, F.lit(0)) - F.col("_least")
    counts = counts.select("tree", "_part", first.alias("_first"), F.sum("_k").over(tree).alias("n"))
    both = ranged.withColumn("_part", part).join(counts, ["tree", "_part"])
    return both.withColumn("pos", F.col("_m") + F.col("_first")).drop("_m", "_part", "_first")


_PATH = "tree binary, pos long, digest binary, carried {carried}, subroot binary, lefts array<string>, rights array<string>"


@dataclass
class Forest:
    """Trees: their blocks, by level of blocks, and their roots ``tree, root, level``."""

    levels: list[DataFrame]
    roots: DataFrame

    def paths(self, tops: DataFrame) -> DataFrame:
        """Every node of the lowest level with the siblings up to the top.

        ``tops`` has what stands above each tree's root: ``tree, subroot, lefts, rights``. Rows are
        ``tree, pos, digest, carried, subroot, lefts, rights``.
        """
        ends = tops.join(self.roots.select("tree", "level"), "tree")
        found = None
        for level, blocks in reversed(list(enumerate(self.levels))):
            here = ends.where(F.col("level") == level)
            above = here.select("tree", F.lit(0).cast("long").alias("block"), "subroot", "lefts", "rights")
            if found is not None:
                above = above.unionByName(found.select("tree", F.col("pos").alias("block"), "subroot", "lefts", "rights"))
            found = _descended(blocks.join(above, ["tree", "block"]))
        return found


def _descended(rows: DataFrame) -> DataFrame:
    kind = rows.select("nodes.carried").schema[0].dataType.elementType
    ddl = _PATH.format(carried=kind.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in ("tree", "n", "runs", "nodes", "subroot")}
                nodes, above = row["nodes"].values, [batch.column(c)[i].as_py() for c in ("lefts", "rights")]
                k, height = len(nodes), min(HEIGHT, height_of(row["n"].as_py()))
                block = row["runs"].as_py()
                found = [siblings(block, height, k, at) for at in range(k)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.repeat(row["tree"], k),
                        nodes.field("pos"),
                        nodes.field("digest"),
                        nodes.field("carried"),
                        pa.repeat(row["subroot"], k),
                        pa.array([x + above[0] for x, _ in found], pa.list_(pa.string())),
                        pa.array([x + above[1] for _, x in found], pa.list_(pa.string())),
                    ],
                    ["tree", "pos", "digest", "carried", "subroot", "lefts", "rights"],
                )

    return rows.mapInArrow(run, ddl)


def _built(nodes: DataFrame) -> DataFrame:
    """Blocks ``tree, block, n, nodes, runs, root`` of nodes ``tree, pos, n, digest, carried``."""
    block = F.expr(f"pos div {FAN**HEIGHT}").alias("block")
    grouped = nodes.groupBy("tree", block).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "digest", "carried"))).alias("nodes")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch.column("nodes").flatten().field("digest").to_pylist()
            ends = np.cumsum(pc.list_value_length(batch.column("nodes")).to_numpy()).tolist()
            found = [
                laid_out(digests[a:b], min(HEIGHT, height_of(n)))
                for a, b, n in zip([0, *ends], ends, batch.column("n").to_pylist(), strict=False)
            ]
            stored = [pa.array([f[i] for f in found], pa.binary()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *stored], [*batch.schema.names, "runs", "root"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in grouped.schema)
    return grouped.mapInArrow(run, f"{ddl}, runs binary, root binary")


def forest(nodes: DataFrame) -> Forest:
    """All trees over ``tree, pos, n, digest, carried``; blocks are written, level by level."""
    levels, roots, span = [], None, FAN**HEIGHT
    longest = nodes.agg(F.max("n")).first()[0] or 1
    while True:
        blocks = written(_built(nodes), f"blocks_{len(levels)}")
        ended = blocks.where(F.col("n") <= span).select("tree", "root", F.lit(len(levels)).alias("level"))
        roots = ended if roots is None else roots.unionByName(ended)
        levels.append(blocks)
        if longest <= span:
            return Forest(levels, roots)
        longest = -(-longest // span)
        nodes = blocks.where(F.col("n") > span).select(
            "tree",
            F.col("block").alias("pos"),
            F.expr(f"(n + {span - 1}) div {span}").alias("n"),
            F.col("root").alias("digest"),
            F.lit(None).cast("string").alias("carried"),
        )


@dataclass
class Manifest:
    """The trees of all sources, the tree above them, and the root's hex digest (None without rows)."""

    sources: Forest
    top: Forest
    root: str | None

    def proofs(self) -> DataFrame:
        """``carried, leaf, subroot, root, lefts, rights`` for every row; digests are hex text."""
        spark = self.top.roots.sparkSession
        nothing = F.array().cast("array<string>")
        tip = spark.range(1).select(
            F.lit(b"").alias("tree"), F.lit(None).cast("binary").alias("subroot"), nothing.alias("lefts"), nothing.alias("rights")
        )
        above = self.top.paths(written(tip, "tip"))
        tops = above.select(F.col("carried").alias("tree"), F.col("digest").alias("subroot"), "lefts", "rights")
        found = self.sources.paths(written(tops, "tops"))
        return found.select(
            "carried",
            F.lower(F.hex("digest")).alias("leaf"),
            F.lower(F.hex("subroot")).alias("subroot"),
            F.lit(self.root).alias("root"),
            "lefts",
            "rights",
        )


def tree_key(source: Column) -> Column:
    """Bytes that order as the sources do, null first; null and empty differ."""
    return F.coalesce(F.concat(F.lit(b"\x01"), source.cast("string").cast("binary")), F.lit(b""))


def manifest(
    docs: DataFrame,
    values: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    source: str = "source",
    carried: Column | None = None,
) -> Manifest:
    """The manifest of ``docs`` over ``values``; ``carried`` is a value per row that proofs show again.

    Leaves of a source are ordered by ``key``, null first; rows of equal key by their digest, so that
    equal rows may change places. Null values, empty and long texts are values like others, other columns
    are not read, and an empty table has no root. The texts are read once and only digests move.
    """
    rows = docs.select(
        tree_key(column(source)).alias("tree"),
        column(key).alias("key"),
        F.unhex(leaf(*(column(v) for v in values))).alias("digest"),
        (carried if carried is not None else column(key)).alias("carried"),
        F.monotonically_increasing_id().alias("row"),
    )
    nodes = placed(written(rows, "leaves"), ["key", "digest", "row"], "ordered")
    sources = forest(nodes.select("tree", "pos", "n", "digest", "carried"))
    subroots = sources.roots.select(F.lit(b"").alias("tree"), F.col("tree").alias("carried"), F.col("root").alias("digest"))
    top = forest(placed(subroots, ["carried"], "subroots").select("tree", "pos", "n", "digest", "carried"))
    tip = top.roots.first()
    return Manifest(sources, top, None if tip is None else bytes(tip["root"]).hex())


def folded(leaf: Column, lefts: Column, rights: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    steps = F.arrays_zip(lefts.alias("a"), rights.alias("b"))
    return F.aggregate(steps, leaf, lambda node, s: F.sha2(F.concat(s["a"], node, s["b"]), 256))


def proof_digest(lefts: Column, rights: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    steps = F.zip_with(lefts, rights, lambda a, b: F.concat(a, b))
    return F.sha2(F.array_join(steps, ""), 256)
