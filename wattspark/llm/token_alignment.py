"""Alignment of two tokenizers' tokens, with corpus-wide counts by external spill counting.

Two tokens of a text are linked if their byte ranges overlap. How often a pair of ids is linked, in
documents, is counted over the corpus, and every document then gets back what its links add up to:

1. Documents are read in chunks. A chunk's records (pair, document, times) are sorted side-major, by
   first and then second id, cut by radix (the first id modulo ``RADIX``) and written as zstd runs.
2. A k-way heap merge of runs counts each pair. It reads the runs a block at a time, merges at most
   ``FAN_IN`` of them and writes one, so that a radix with many runs is merged by many tasks, level by
   level, until one run is left. Its order puts all pairs of a first id side by side, which yields the
   highest count of the id. Its size is bounded by the vocabularies, not by the corpus.
3. The runs are read again beside the counts of their radix, at most ``FAN_IN`` runs to a copy, and what
   each record contributes to its document streams back: no pair, however common, is gathered.

Both tokenizers treat a blank and what follows it by itself, so a text is cut before blanks that follow
no white space into units, and each distinct unit of a chunk is encoded and linked once.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from wattspark.llm.common import gathered, written
from wattspark.llm.token_rollup import PATTERN

RADIX = 32
FAN_IN = 64
CHUNK = 8 << 20  # bytes of text whose records are sorted at once
BLOCK = 1 << 14  # records of a run in memory during a merge
SPACE = "▁"  # fixed value: how the second vocabulary writes a blank

_CUT = re.compile(r"(?<=\S)(?= [\s\S])")
# White space, in the widest sense, before a blank.
_ODD = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "


def _letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves,
    the others the letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """A byte-level BPE vocabulary (JSON) and a sentence-piece model, as the files' bytes."""

    def __init__(self, bpe: bytes, pieces: bytes):
        self.files, self._loaded = (bpe, pieces), None

    @classmethod
    def from_folder(cls, folder: str, bpe: str = "byte_bpe_50k.json", pieces: str = "piece_bpe_32k.model") -> Tokenizers:
        """Read by the driver; the files (some MB) travel with the query, so executors need none."""
        try:
            with open(f"{folder}/{bpe}", "rb") as a, open(f"{folder}/{pieces}", "rb") as b:
                return cls(a.read(), b.read())
        except FileNotFoundError as e:
            raise FileNotFoundError(f"no tokenizer file {e.filename}; name the folder that holds them") from e

    def __getstate__(self):
        return {"files": self.files, "_loaded": None}

    def loaded(self):
        """Both encoders, and the bytes of each id."""
        if self._loaded is None:
            import sentencepiece
            import tiktoken

            bpe, letters = json.loads(self.files[0]), _letters()
            vocabulary, special = bpe["model"]["vocab"], {t["id"] for t in bpe.get("added_tokens", ())}
            merged = [m if isinstance(m, list) else m.split(" ") for m in bpe["model"]["merges"]]
            ranks = [vocabulary["".join(m)] for m in merged]
            if ranks != sorted(ranks):
                raise ValueError("ids are not in the order of the merges")
            entries = {i: bytes(map(letters.__getitem__, t)) for t, i in vocabulary.items() if i not in special}
            first = [entries.get(i, b"") for i in range(max(vocabulary.values()) + 1)]
            plain = tiktoken.Encoding(
                "entries", pat_str=PATTERN, mergeable_ranks={t: i for i, t in entries.items()}, special_tokens={}
            )
            pieces = sentencepiece.SentencePieceProcessor(model_proto=self.files[1])
            second = []
            for i in range(pieces.get_piece_size()):
                piece = pieces.id_to_piece(i)
                if SPACE in piece.lstrip(SPACE):
                    raise ValueError(f"piece {piece} has a blank inside")
                second.append(bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace(SPACE, " ").encode())
            self._loaded = plain.encode_ordinary, lambda texts: pieces.encode(texts, num_threads=1), first, second
        return self._loaded


@dataclass
class Units:
    """Distinct units: token, group and link counts, their groups as text, and their links' pairs."""

    sound: np.ndarray  # whether both sides' bytes give the unit
    counts: np.ndarray  # first ids, second ids, groups, links: a row each
    groups: list[str]
    ends: np.ndarray  # of each unit's links in ``pairs``
    pairs: np.ndarray  # first id * size of the second vocabulary + second id


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int64, int(sizes.sum())), sizes


def linked(units: list[str], tokenizers: Tokenizers) -> Units:
    """Encode units, each of which starts with a blank, and link their tokens."""
    encode, encode_all, first, second = tokenizers.loaded()
    raw = [u.encode() for u in units]
    a_ids, b_ids = list(map(encode, units)), encode_all([u[1:] for u in units])
    whole = b"".join
    sound = [
        whole(map(first.__getitem__, a)) == r == whole(map(second.__getitem__, b))
        for a, b, r in zip(a_ids, b_ids, raw, strict=True)
    ]
    if not all(sound):
        a_ids, b_ids = ([x if s else [] for x, s in zip(ids, sound, strict=True)] for ids in (a_ids, b_ids))
        raw = [r if s else b"" for r, s in zip(raw, sound, strict=True)]
    (a, n_a), (b, n_b) = _flat(a_ids), _flat(b_ids)
    a_ends, b_ends = (
        np.cumsum(np.fromiter(map(len, table), np.int64, len(table))[ids]) for table, ids in ((first, a), (second, b))
    )
    limits = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
    edges, cuts = np.union1d(a_ends, b_ends), np.intersect1d(a_ends, b_ends, assume_unique=True)
    pairs = a[np.searchsorted(a_ends, edges)] * len(second) + b[np.searchsorted(b_ends, edges)]
    # a unit without sound tokens has no bytes and no edges: its limit is that of the unit before
    n_links = np.diff(np.searchsorted(edges, limits, "right"), prepend=0)
    n_groups = np.diff(np.searchsorted(cuts, limits, "right"), prepend=0)
    groups = _group_texts(a, b, a_ends, b_ends, cuts, limits, np.array(sound, bool))
    return Units(np.array(sound, bool), np.stack([n_a, n_b, n_groups, n_links]), groups, np.cumsum(n_links), pairs)


def _group_texts(a, b, a_ends, b_ends, cuts, limits, sound) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` for every unit, from one text of all."""
    size = int(max(a.max(initial=0), b.max(initial=0))) + 1
    texts = [f"{i}{mark}" for mark in ",|;\n" for i in range(size)]
    a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
    b_before, a_upto = np.searchsorted(b_group, a_group), np.searchsorted(a_group, b_group, "right")
    code = np.empty(len(a) + len(b), np.int64)
    code[np.arange(len(a)) + b_before] = a + size * np.isin(a_ends, cuts, assume_unique=True)
    closing = 2 * np.isin(b_ends, cuts, assume_unique=True) + np.isin(b_ends, limits)
    code[np.arange(len(b)) + a_upto] = b + size * closing
    lines = iter("".join(map(texts.__getitem__, code.tolist())).split("\n"))
    return [next(lines) if s else "" for s in sound.tolist()]


def cut(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The units of texts that are neither null nor empty, without their leading blank: the texts'
    numbers in a new order, the units of all texts in that order, and the units of each."""
    odd = pc.match_substring_regex(texts, _ODD)
    odd = pc.or_(odd, pc.or_(pc.starts_with(texts, " "), pc.ends_with(texts, " "))).to_numpy(zero_copy_only=False)
    plain, rest = np.flatnonzero(~odd), np.flatnonzero(odd)
    lists = pc.split_pattern(texts.take(pa.array(plain)), " ")
    by_hand = [[u[1:] for u in _CUT.split(" " + t)] for t in texts.take(pa.array(rest)).to_pylist()]
    lists = pa.concat_arrays([lists, pa.array(by_hand, lists.type)])
    return np.concatenate([plain, rest]), pc.list_flatten(lists), pc.list_value_length(lists).to_numpy()


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpacked(packed: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed), kind)


@dataclass
class Records:
    """Pairs of a chunk, by radix and side-major; documents that hold each, and times there."""

    keys: np.ndarray
    held: np.ndarray  # documents of each pair
    docs: np.ndarray
    times: np.ndarray


def _radix_major(keys: np.ndarray, size: int) -> np.ndarray:
    """Keys as numbers that order by radix and then side-major; ``size`` is that of the second vocabulary."""
    return (keys // size % RADIX) << 48 | keys


_KEY = (1 << 48) - 1


def records(doc: np.ndarray, unit: np.ndarray, units: Units, size: int) -> Records:
    """Of the occurrences of units in documents."""
    known, place = np.unique(_radix_major(units.pairs, size), return_inverse=True)
    code, times = np.unique(doc.astype(np.int64) * len(units.ends) + unit, return_counts=True)
    doc, unit = np.divmod(code, len(units.ends))
    n = units.counts[3][unit]
    at = np.arange(int(n.sum())) + np.repeat(units.ends[unit] - np.cumsum(n), n)
    docs = int(doc.max(initial=0)) + 1
    code = place[at] * docs + np.repeat(doc, n)
    order = np.argsort(code)
    code = code[order]
    new = np.flatnonzero(np.diff(code, prepend=-1))
    times = np.add.reduceat(np.repeat(times, n)[order], new) if len(new) else np.empty(0, np.int64)
    pair, doc = np.divmod(code[new], docs)
    return Records(known, np.bincount(pair, minlength=len(known)), doc.astype(np.int32), times)


_FACTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_SPILLED = f"chunk long, doc int, {_FACTS}, radix int, keys binary, held binary, docs binary, times binary"
_SCHEMA = pa.schema(
    [
        (name, {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[kind])
        for name, kind in (c.split() for c in _SPILLED.split(", "))
    ]
)


def _batch(columns: dict) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _SCHEMA]
    return pa.RecordBatch.from_arrays(arrays, schema=_SCHEMA)


def _spilled(ids: pa.Array, texts: pa.Array, chunk: int, tokenizers: Tokenizers) -> Iterator[pa.RecordBatch]:
    """A chunk's rows: a row of facts for every document, and a run of records for every radix."""
    some = pc.greater(pc.binary_length(texts), 0).fill_null(False)
    none = ids.filter(pc.invert(some))
    if len(none):
        zero, number = np.zeros(len(none), np.int64), pa.nulls(len(none), pa.int32())
        facts = {n: zero for n in ("n_a", "n_b", "n_groups", "n_links")}
        yield _batch({"chunk": np.full(len(none), chunk), "doc": number, "doc_id": none, **facts, "groups_sha256": [""] * len(none)})
    ids, texts = ids.filter(some), texts.filter(some)
    if not len(ids):
        return
    order, flat, sizes = cut(texts)
    coded = flat.dictionary_encode()
    units = linked([" " + u for u in coded.dictionary.to_pylist()], tokenizers)
    unit = coded.indices.to_numpy()
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sound = np.logical_and.reduceat(units.sound[unit], starts)
    counts = [np.where(sound, np.add.reduceat(c[unit], starts), 0) for c in units.counts]
    digests = []
    for a, b, good in zip(starts.tolist(), ends.tolist(), sound.tolist(), strict=True):
        text = ";".join(map(units.groups.__getitem__, unit[a:b].tolist())) if good else None
        digests.append("" if text is None else hashlib.sha256(text.encode()).hexdigest())
    names = ("n_a", "n_b", "n_groups", "n_links")
    doc = np.arange(len(order), dtype=np.int32)
    yield _batch(
        {"chunk": np.full(len(order), chunk), "doc": doc, "doc_id": ids.take(pa.array(order)), **dict(zip(names, counts, strict=True)), "groups_sha256": digests}
    )
    use = np.repeat(sound, sizes)
    found = records(np.repeat(doc, sizes)[use], unit[use], units, len(tokenizers.loaded()[3]))
    edges = np.searchsorted(found.keys, np.arange(RADIX + 1) << 48)
    upto = np.concatenate([[0], np.cumsum(found.held)])
    for r in range(RADIX):
        a, b = edges[r], edges[r + 1]
        held = found.held[a:b]
        keys, held = (found.keys[a:b] & _KEY)[held > 0], held[held > 0]
        if len(keys):
            x, y = upto[a], upto[b]
            run = {"keys": keys, "held": held, "docs": found.docs[x:y], "times": found.times[x:y].astype(np.int32)}
            yield _batch({"chunk": [chunk], "radix": [r], **{k: [_packed(v)] for k, v in run.items()}})


def _spill(rows: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """Facts and runs of ``doc_id, text``, chunk by chunk. Chunks are numbered by task; the rows must be
    written, so that the numbers stay."""
    sent = rows.sparkSession.sparkContext.broadcast(tokenizers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for i, chunk in enumerate(gathered(batches, "text", CHUNK)):
            yield from _spilled(chunk.column("doc_id"), chunk.column("text"), first + i, sent.value)

    return rows.mapInArrow(run, _SPILLED)


class _Run:
    """A run, read a block at a time."""

    def __init__(self, keys: bytes, held: bytes):
        self.readers = [zstandard.ZstdDecompressor().stream_reader(x) for x in (keys, held)]
        self.keys = self.held = np.empty(0, np.int64)

    def read(self) -> bool:
        parts = []
        for reader in self.readers:
            got = bytearray()
            while len(got) < 8 * BLOCK and (more := reader.read(8 * BLOCK - len(got))):
                got += more
            parts.append(np.frombuffer(bytes(got), np.int64))
        self.keys, self.held = parts
        return len(self.keys) > 0

    def take(self, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """The records up to a key."""
        n = int(np.searchsorted(self.keys, limit, "right"))
        out = self.keys[:n], self.held[:n]
        self.keys, self.held = self.keys[n:], self.held[n:]
        return out


def merged(runs: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all runs, in order, with their added counts.

    The heap has the last key in memory of every run. Up to the smallest of them all runs are in
    memory; these records are added up, and the run that ends there reads on.
    """
    opened = [r for r in (_Run(*r) for r in runs) if r.read()]
    heap = [(int(r.keys[-1]), i) for i, r in enumerate(opened)]
    heapq.heapify(heap)
    keys, held = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while heap:
        limit, i = heapq.heappop(heap)
        parts = [opened[j].take(limit) for _, j in heap] + [opened[i].take(limit)]
        key, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        keys.append(key)
        added = np.zeros(len(key), np.int64)
        np.add.at(added, place, np.concatenate([p[1] for p in parts]))
        held.append(added)
        if opened[i].read():
            heapq.heappush(heap, (int(opened[i].keys[-1]), i))
        else:
            opened[i] = None
    return np.concatenate(keys), np.concatenate(held)


_RUN = "radix int, chunk long, keys binary, held binary"


def _merge(runs: DataFrame, groups: int) -> DataFrame:
    """One run of each radix and group of runs, numbered by the group."""
    dealt = runs.withColumn("chunk", F.pmod(F.xxhash64("chunk"), F.lit(groups))).repartition("radix", "chunk")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in chain(batches, [None]):
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True) if batch else [(None,) * 4]
            for radix, group, keys, counts in rows:
                if last is not None and (radix, group) != last:
                    out = map(_packed, merged(held))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([last[0]], pa.int32()), pa.array([last[1]], pa.int64()), *(pa.array([x], pa.binary()) for x in out)],
                        ["radix", "chunk", "keys", "held"],
                    )
                    held = []
                last = (radix, group)
                held.append((keys, counts))

    return dealt.sortWithinPartitions("radix", "chunk").mapInArrow(run, _RUN)


def pair_counts(runs: DataFrame) -> tuple[DataFrame, int]:
    """One run ``radix, keys, held`` of each radix, and how many groups of ``FAN_IN`` runs there were."""
    number = runs.select("chunk").distinct().count()
    groups = rest = max(1, -(-number // FAN_IN))
    level = 0
    while True:
        runs = written(_merge(runs.select("radix", "chunk", "keys", "held"), rest), f"counts_{level}")
        if rest == 1:
            return runs.select("radix", "keys", "held"), groups
        rest, level = -(-rest // FAN_IN), level + 1


def _contributions(runs: DataFrame, counts: DataFrame, groups: int, size: int) -> DataFrame:
    """``chunk, doc, n_best, count_sum``: what a radix gives to each document."""
    salted = runs.withColumn("salt", F.pmod(F.xxhash64("chunk"), F.lit(groups)))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("salt")
    none = [F.lit(None).cast("binary").alias(c) for c in ("docs", "times")]
    copies = counts.select("radix", salts, F.lit(None).cast("long").alias("chunk"), "keys", "held", *none)
    both = copies.unionByName(salted.select(*copies.columns)).repartition("radix", "salt")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = total = best = None
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, keys, held, docs, times = (batch.column(c)[i].as_py() for c in range(2, 7))
                keys, held = _unpacked(keys, np.int64), _unpacked(held, np.int64)
                if chunk is None:  # the counts come first
                    known, total = keys, held
                    head = np.flatnonzero(np.diff(known // size, prepend=-1))
                    most = np.maximum.reduceat(total, head)
                    best = total == np.repeat(most, np.diff(np.append(head, len(known))))
                    continue
                at = np.repeat(np.searchsorted(known, keys), held)
                docs, times = _unpacked(docs, np.int32), _unpacked(times, np.int32)
                n = int(docs.max()) + 1
                some = np.flatnonzero(np.bincount(docs, minlength=n))
                sums = np.zeros((2, n), np.int64)
                np.add.at(sums[0], docs, times * best[at])
                np.add.at(sums[1], docs, times * total[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(chunk, pa.int64()), len(some)), pa.array(some, pa.int32()), *(pa.array(s[some]) for s in sums)],
                    ["chunk", "doc", "n_best", "count_sum"],
                )

    rows = both.sortWithinPartitions("radix", "salt", F.col("chunk").asc_nulls_first())
    return rows.mapInArrow(run, "chunk long, doc int, n_best long, count_sum long")


def aligned(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``.

    A text is encoded with a blank before it, without special tokens. Where the bytes of either side's
    tokens are not that text, and for null and empty texts, there are no tokens: the counts are 0 and
    ``groups_sha256`` is empty. ``n_best`` counts the links whose pair is in the most documents of all
    pairs of its first id, ties included; ``count_sum`` adds up the pairs' counts over all links. Every
    row is a document, whether its id is null, repeated or neither. Other columns are not read, and an
    empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spilled = written(_spill(rows, tokenizers), "spilled")
    runs = spilled.where("radix IS NOT NULL").select("radix", "chunk", "keys", "held", "docs", "times")
    counts, groups = pair_counts(runs)
    given = _contributions(runs, counts, groups, len(tokenizers.loaded()[3]))
    given = given.groupBy("chunk", "doc").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    facts = spilled.where("radix IS NULL").select("chunk", "doc", *(c.split()[0] for c in _FACTS.split(", ")))
    zero = F.lit(0).cast("long")
    return facts.join(given.hint("merge"), ["chunk", "doc"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
