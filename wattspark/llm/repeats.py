"""Where a window of symbols occurs more than once: what substring and suffix-array dedup share.

A window is ``length`` consecutive symbols (words, bytes) of one document. Of its ``gram``-symbol
pieces the one with the smallest hash, the leftmost on a tie, is its anchor: equal windows have
equal anchors. Consecutive windows with the same anchor form a segment, so every window is in
exactly one segment, and equal windows are in segments of equal key. That turns one comparison of
all text with all text into many small ones, the reference shards: a key with its segments.

1. Count the keys; only those met twice can hold a repeat. Their bits in a map of bounded size let
   the second reading drop the other segments where it finds them; if the map fills, more segments
   go on and the result is the same.
2. Segments of equal content are aggregated to one representative with a count.
3. The symbols of every content whose key occurs twice are fetched, also of those that only have copies,
   and the operator's own method decides which of their windows occur again. A key with more than
   ``HOT_KEY`` contents is split into its windows instead, which are aggregated by their hash.
4. What is found becomes spans of all places of the content, which are applied to the whole texts.

Documents are named by ``doc`` and ``sub``; ``sub`` is 0 where ids are unique.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, functions as F

from wattspark.llm.common import bit_map, bytes_of, in_map, scrambled, written

HOT_KEY = 8192
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
CHUNK = 1 << 17  # symbols handled at once
BLOCK = 1 << 23  # of a document longer than that
NO_ID = (1 << 63) - 1

_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


@dataclass
class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as many as were asked for."""

    up: np.ndarray
    down: np.ndarray

    @classmethod
    def of(cls, n: int) -> Powers:
        one = np.ones(1, np.uint64)
        up = np.multiply.accumulate(np.concatenate([one, np.full(n, _STEP, np.uint64)]))
        down = np.multiply.accumulate(np.concatenate([one, np.full(n, _BACK, np.uint64)]))
        return cls(up, down)


class Sequences:
    """Hashes of runs of symbols by prefix sums: a run's hash does not depend on its place."""

    powers = Powers.of(CHUNK)

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        if n >= len(Sequences.powers.up):
            Sequences.powers = Powers.of(2 * n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * Sequences.powers.up[:n], out=self.sums[1:])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return scrambled((self.sums[ends] - self.sums[starts]) * Sequences.powers.down[starts])

    def grams(self, k: int) -> np.ndarray:
        """Hash of every run of ``k`` symbols; its high bits are mixed, which is what anchors compare."""
        n = max(len(self.sums) - k, 0)
        out = self.sums[k : k + n] - self.sums[:n]
        out *= Sequences.powers.down[:n]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        return out


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    have, out = 1, values
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


@dataclass
class Segments:
    row: np.ndarray  # document of the chunk
    start: np.ndarray  # first symbol in the document
    windows: np.ndarray  # windows that start in the segment
    key: np.ndarray
    content: np.ndarray  # hash of all its symbols


def segments(symbols: list[np.ndarray], length: int, gram: int) -> Segments:
    """Segments of the documents given by their symbols (64-bit hashes)."""
    parts = [(i, at, s[at : at + BLOCK + length - 1]) for i, s in enumerate(symbols) for at in range(0, len(s), BLOCK)]
    parts = [(i, at, s) for i, at, s in parts if len(s) >= length]
    if sum(len(s) for _, _, s in parts) < BLOCK:
        return _segments(parts, length, gram)
    found = [_segments([p], length, gram) for p in parts]
    return Segments(*(np.concatenate([getattr(f, c.name) for f in found]) for c in fields(Segments)))


def _segments(parts: list[tuple[int, int, np.ndarray]], length: int, gram: int) -> Segments:
    none = np.empty(0, np.int64)
    if not parts:
        return Segments(none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    sizes = np.array([len(s) for _, _, s in parts], np.int64)
    bases = np.cumsum(sizes) - sizes
    seq = Sequences(np.concatenate([s for _, _, s in parts]))
    grams = seq.grams(gram)
    low = np.uint64((1 << 24) - 1)
    packed = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    anchors = (sliding_min(packed, length - gram + 1) & low).astype(np.int64)
    n = sizes - length + 1
    part = np.repeat(np.arange(len(parts)), n)
    at = np.arange(len(part)) + np.repeat(bases - (np.cumsum(n) - n), n)
    anchor = anchors[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(at)))
    starts, where = at[first], part[first]
    rows = np.array([i for i, _, _ in parts], np.int64)
    offsets = np.array([a for _, a, _ in parts], np.int64) - bases
    content = seq.runs(starts, starts + windows + length - 1)
    return Segments(rows[where], starts + offsets[where], windows, grams[anchor[first]], content)


def chunks(texts: list[bytes], symbols: Callable[[bytes], np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Documents' symbols, some documents at a time, with the number of the first."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(symbols(text))
        size += len(held[-1])
        if size >= CHUNK:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


@dataclass(frozen=True)
class Method:
    """What an operator brings: symbols, window and gram length, and how contents are compared.

    ``cut`` gives the bytes of a run of symbols. ``compare`` takes the contents of whole keys, with
    their windows, counts and first places, and gives the flagged windows as runs ``(row, offset, windows,
    copies)``: of the content's first place, or of all its other places.
    """

    length: int
    gram: int
    symbols: Callable[[bytes], np.ndarray]
    units: Callable[[bytes], list[bytes] | bytes]
    cut: Callable[[list[bytes] | bytes, int, int], bytes]
    compare: Callable[[list[bytes], np.ndarray, np.ndarray, list[tuple]], list[tuple[int, int, int, bool]]]
    keep_first: bool


def named(docs: DataFrame) -> DataFrame:
    """``doc_id, doc, sub, text``: rows that cannot be told apart by id are numbered, in a written copy."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), bytes_of(F.col("text")).alias("text"))
    doc = F.coalesce("doc_id", F.lit(NO_ID)).alias("doc")
    again = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if again.isEmpty():
        return rows.select("doc_id", doc, F.lit(0).cast("long").alias("sub"), "text")
    numbered = written(rows.withColumn("sub", F.monotonically_increasing_id()), "numbered")
    return numbered.select("doc_id", doc, "sub", "text")


def _packed(rows: DataFrame, docs: np.ndarray | None = None) -> DataFrame:
    """``doc, sub, packed``: the texts compressed, as they cross the network; with ``docs`` those whose bit is set."""
    sent = rows.sparkSession.sparkContext.broadcast(docs) if docs is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            if sent is not None:
                batch = batch.filter(pa.array(in_map(batch.column(0).to_numpy().view(np.uint64), sent.value)))
            texts = pa.array([pack(t) for t in batch.column(2).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], texts], ["doc", "sub", "packed"])

    return rows.select("doc", "sub", "text").mapInArrow(run, "doc long, sub long, packed binary")


def unpack(packed: bytes) -> bytes:
    return zstandard.decompress(packed)


def _matching(rows: DataFrame, column: str, keys: np.ndarray) -> DataFrame:
    """The rows whose bit is set: all that matter, and some more."""
    sent = rows.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(column).to_numpy().view(np.uint64)
            yield batch.filter(pa.array(in_map(values, sent.value)))

    return rows.mapInArrow(run, rows.schema)


def _bits(keys: DataFrame, column: str) -> np.ndarray:
    """Bit map of a written table's keys: 16 bits a key, between the bounds."""
    bits = min(max(1 << (16 * keys.count()).bit_length(), LEAST_BITS), MOST_BITS)
    return bit_map(keys, column, bits)


_PLACE = "doc long, sub long, start int, windows int, key long, content long"


def _found(rows: DataFrame, m: Method, keys: np.ndarray | None) -> DataFrame:
    """Keys of all segments, or the segments whose key has its bit set."""
    sent = rows.sparkSession.sparkContext.broadcast(keys) if keys is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, sub = (batch.column(i).to_numpy() for i in (0, 1))
            for first, held in chunks(batch.column(2).to_pylist(), m.symbols):
                s = segments(held, m.length, m.gram)
                if sent is None:
                    yield pa.RecordBatch.from_arrays([pa.array(s.key.view(np.int64))], ["key"])
                    continue
                keep = in_map(s.key, sent.value)
                row = first + s.row[keep]
                columns = (
                    doc[row],
                    sub[row],
                    s.start[keep].astype(np.int32),
                    s.windows[keep].astype(np.int32),
                    s.key[keep].view(np.int64),
                    s.content[keep].view(np.int64),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["doc", "sub", "start", "windows", "key", "content"]
                )

    return rows.select("doc", "sub", "text").mapInArrow(run, "key long" if keys is None else _PLACE)


_CUT = "key long, n long, doc long, sub long, start int, windows int, content long, bytes binary"
_HASHED = "key long, window long, n long, doc long, sub long, start int"
_WANTED = ("doc", "sub", "start", "windows", "key", "n", "content")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _beside(packed: DataFrame, marks: DataFrame) -> DataFrame:
    """Each text's row and then the rows of its document, as ``together`` reads them: one sort and neither join nor lists."""
    rows = packed.unionByName(marks, allowMissingColumns=True)
    return rows.repartition("doc", "sub").sortWithinPartitions("doc", "sub", "start")


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], np.ndarray, pa.RecordBatch]]:
    """Rows of texts, these texts, how many marks each has, and the marks' rows; a text is never parted from its marks."""
    held: list[pa.RecordBatch] = []
    for batch in batches:  # sorted: a text is the first row of its document
        texts = np.flatnonzero(batch.column("packed").is_valid().to_numpy(zero_copy_only=False))
        if held and len(texts):
            yield _parted([*held, batch.slice(0, texts[-1])])
            held, batch = [], batch.slice(texts[-1])
        held.append(batch)
    if sum(b.num_rows for b in held):
        yield _parted(held)


def _parted(held: list[pa.RecordBatch]) -> tuple[pa.RecordBatch, list[bytes], np.ndarray, pa.RecordBatch]:
    rows = _joined(held)
    is_text = rows.column("packed").is_valid()
    at = np.flatnonzero(is_text.to_numpy(zero_copy_only=False))
    texts = rows.filter(is_text)
    unpacked = [unpack(t) for t in texts.column("packed").to_pylist()]
    return texts, unpacked, np.diff(np.append(at, rows.num_rows)) - 1, rows.filter(pc.invert(is_text))


def _columns(marks: pa.RecordBatch, names: tuple[str, ...]) -> dict[str, np.ndarray]:
    return {c: marks.column(c).to_numpy(zero_copy_only=False) for c in names}


def _fetched(packed: DataFrame, wanted: DataFrame, m: Method) -> DataFrame:
    """Contents of the representatives ``wanted``, by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, sizes, marks in together(batches):
            w = _columns(marks, _WANTED)
            stops = w["start"] + w["windows"] + (m.length - 1)
            begun, parts = 0, []
            for text, end in zip(texts, np.cumsum(sizes).tolist(), strict=True):
                at = begun + len(parts)
                if at < end:
                    units = m.units(text)
                    runs = zip(w["start"][at:end].tolist(), stops[at:end].tolist(), strict=True)
                    parts += [m.cut(units, a, b) for a, b in runs]
                if len(parts) > 20_000 or parts and end == marks.num_rows:
                    columns = [pa.array(w[c][begun:end]) for c in _names(_CUT)[:-1]]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.binary())], _names(_CUT))
                    begun, parts = end, []

    return _beside(packed, wanted.select(*_WANTED)).mapInArrow(run, _CUT).repartition("key")


def _windows(packed: DataFrame, wanted: DataFrame, m: Method) -> DataFrame:
    """The hashes of all windows of the representatives ``wanted``, by key and window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, sizes, marks in together(batches):
            w = _columns(marks, _WANTED)
            for i, end in enumerate(np.cumsum(sizes).tolist()):
                if not sizes[i]:
                    continue
                seq, first = Sequences(m.symbols(texts[i])), end - sizes[i]
                row = np.repeat(np.arange(first, end), w["windows"][first:end])
                for at in range(0, len(row), CHUNK):
                    r = row[at : at + CHUNK]
                    ahead = np.cumsum(w["windows"][first:end], dtype=np.int64) - w["windows"][first:end]
                    start = w["start"][r] + np.arange(at, at + len(r)) - ahead[r - first]
                    hashed = seq.runs(start, start + m.length).view(np.int64)
                    columns = (w["key"][r], hashed, w["n"][r], w["doc"][r], w["sub"][r], start.astype(np.int32))
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], _names(_HASHED))

    return _beside(packed, wanted.select(*_WANTED)).mapInArrow(run, _HASHED).repartition("key", "window")


_SPAN = "doc long, sub long, start int, windows int, copies boolean, first int, key long, content long"
SHARD_BYTES = 1 << 20


def _compared(fetched: DataFrame, m: Method) -> DataFrame:
    """Flagged windows of the contents of keys that are not hot, shard by shard: of the first place
    ``doc, sub, first``, or with ``copies`` of all others; ``start`` is within the content."""
    rows = fetched.sortWithinPartitions("key")

    def shard(held: pa.RecordBatch) -> pa.RecordBatch:
        key, n = held.column("key").to_numpy(), held.column("n").to_numpy()
        same = key[1:] == key[:-1]
        # keys that the bit map let through have one place
        some = (n > 1) | np.append(same, False) | np.insert(same, 0, False)
        held = held.filter(pa.array(some))
        key, n, doc, sub, first, windows, content = (c.to_numpy() for c in held.columns[:7])
        places = list(zip(doc.tolist(), sub.tolist(), first.tolist(), strict=True))
        found = m.compare(held.column("bytes").to_pylist(), windows.astype(np.int64), n, places)
        row, at, many, copies = np.array(found, np.int64).reshape(-1, 4).T
        columns = (doc[row], sub[row], at.astype(np.int32), many.astype(np.int32), copies == 1, first[row], key[row], content[row])
        return pa.RecordBatch.from_arrays([*map(pa.array, columns)], _names(_SPAN))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            key = batch.column("key").to_numpy()
            ends = np.cumsum(pc.binary_length(batch.column("bytes")).to_numpy(), dtype=np.int64)
            last = held[-1].column("key")[-1].as_py() if held else None
            begun = done = 0  # rows and bytes of this batch that went into shards
            for at in np.flatnonzero(np.append(len(key) > 0 and last is not None and key[0] != last, key[1:] != key[:-1])).tolist():
                upto = int(ends[at - 1]) if at else 0
                if size + upto - done > SHARD_BYTES:  # a shard holds whole keys
                    yield shard(_joined([*held, batch.slice(begun, at - begun)]))
                    held, size, begun, done = [], 0, at, upto
            if begun < len(key):
                held.append(batch.slice(begun))
                size += int(ends[-1]) - done
        if held:
            yield shard(_joined(held))

    return rows.mapInArrow(run, _SPAN)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def repeated(docs: DataFrame, m: Method) -> tuple[DataFrame, DataFrame]:
    """The packed rows, and the spans ``doc, sub, start, windows`` of windows to remove.

    With ``keep_first`` these are windows that also start earlier, by ``doc, sub, start``; else all
    windows that start anywhere else.
    """
    rows = named(docs)
    twice = _found(rows, m, None).groupBy("key").agg(F.count("*").alias("n")).where("n >= 2").select("key")
    twice = written(twice, "keys")
    places = written(_found(rows, m, _bits(twice, "key")), "segments")
    place = F.struct("doc", "sub", "start")
    contents = written(
        places.groupBy("key", "content").agg(
            F.count("*").alias("n"), F.min(place).alias("first"), F.min("windows").alias("windows")
        ),
        "contents",
    )
    known = written(contents.where("n >= 2").select("content"), "known")
    again = _matching(places.select("doc", "sub", "start", "windows", "key", "content"), "content", _bits(known, "content"))
    hot = contents.groupBy("key").agg(F.count("*").alias("k")).where(F.col("k") > HOT_KEY)
    hot = written(hot.select(F.col("key").alias("_key"), F.lit(True).alias("hot")), "hot")
    wanted = contents.select("first.*", "windows", "key", "n", "content").join(hot, F.col("key") == F.col("_key"), "left")
    wanted = written(wanted.drop("_key").withColumn("hot", F.coalesce("hot", F.lit(False))), "wanted")
    packed = _packed(rows)
    compared = written(_compared(_fetched(packed, wanted.where("NOT hot"), m), m), "compared")
    spans = compared.where("NOT copies").select("doc", "sub", (F.col("first") + F.col("start")).alias("start"), "windows")
    # copies of a content: by what was found in it, and whole where its key is hot
    found = compared.where("copies").select("key", "content", "doc", "sub", "first", F.col("start").alias("at"), "windows")
    if not hot.isEmpty():  # else the texts would be read again for no window; only those that hold some are dealt
        holders = written(wanted.where("hot").select("doc").distinct(), "holders")
        parts = _windows(_packed(rows, _bits(holders, "doc")), wanted.where("hot"), m)
        same = parts.groupBy("key", "window").agg(F.sum("n").alias("all"), F.min(place).alias("first"), F.count("*").alias("k"))
        same = same.where("k >= 2").select(F.col("key").alias("_key"), F.col("window").alias("_window"), "first")
        split = parts.join(same, (F.col("key") == F.col("_key")) & (F.col("window") == F.col("_window")))
        if m.keep_first:
            split = split.where(place != F.col("first"))
        spans = spans.unionByName(split.select("doc", "sub", "start", F.lit(1).alias("windows")))
        whole = wanted.where("hot AND n >= 2").select("key", "content", "doc", "sub", F.col("start").alias("first"), F.lit(0).alias("at"), "windows")
        found = found.unionByName(whole)
        if not m.keep_first:  # nor does the first of them stay
            found = found.unionByName(whole.withColumn("doc", F.lit(None).cast("long")))
    found = found.select(*(F.col(c).alias(f"_{c}") for c in found.columns))
    # one plan for every size: sent to all while it is small and dealt later, it would cost a step in between
    copies = again.join(found.hint("merge"), (F.col("key") == F.col("_key")) & (F.col("content") == F.col("_content")))
    other = ~(F.col("doc").eqNullSafe(F.col("_doc")) & F.col("sub").eqNullSafe(F.col("_sub")) & F.col("start").eqNullSafe(F.col("_first")))
    copies = copies.where(other).select("doc", "sub", (F.col("start") + F.col("_at")).alias("start"), F.col("_windows").alias("windows"))
    return packed, spans.unionByName(copies)


def covered(n: int, starts: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """Which of ``n`` symbols lie in a window of the spans."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + windows + (length - 1), minlength=n + 1)
    return np.cumsum(edge)[:n] > 0


def with_spans(packed: DataFrame, spans: DataFrame) -> DataFrame:
    """Every row's text and then its spans, for ``spanned``."""
    return _beside(packed, spans.select("doc", "sub", "start", "windows"))


def spanned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[tuple[bytes, np.ndarray, np.ndarray]]]]:
    """Ids of some documents of ``with_spans``, and their texts with the starts and windows of their spans."""
    for rows, texts, sizes, marks in together(batches):
        doc = rows.column("doc")
        ids = pc.if_else(pc.equal(doc, NO_ID), pa.scalar(None, pa.int64()), doc)
        w = {c: x.astype(np.int64) for c, x in _columns(marks, ("start", "windows")).items()}
        ends = np.cumsum(sizes).tolist()
        yield ids, [(t, w["start"][a:b], w["windows"][a:b]) for t, a, b in zip(texts, [0, *ends], ends)]
