"""Suffix-array dedup by bucket-pointer refinement.

The positions of a shard of text pieces that share anchors (see ``repeats``) are sorted by what
follows them. They first fall into buckets by their q-gram. A bucket is refined by sorting its
positions on the bucket identifiers at the offsets behind what the bucket is already sorted by; the new
identifiers are used by the next refinement, which so reaches two or three times as far. Positions alone
in their bucket are done and are not sorted again. Refinement ends at the window length: positions that then
share a bucket start equal windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wattspark.llm.common import scrambled
from wattspark.llm.repeats import Method, covered, repeated, spanned, with_spans

BYTES = 100
GRAM = 8  # bytes of the initial buckets


def refine(bucket: np.ndarray, later: list[np.ndarray], bits: int) -> np.ndarray:
    """New bucket identifiers, in order: by the old ones, then by those at ``later`` offsets.

    Identifiers have ``bits`` bits; all that decide together fit into 64. They leave gaps of the bucket's
    size, so that positions alone keep theirs and a refined bucket has room for its parts.
    """
    todo = np.flatnonzero(np.bincount(bucket)[bucket] > 1) if len(bucket) else bucket
    if not len(todo):
        return bucket
    code = bucket[todo].astype(np.uint64)
    for by in later:
        code <<= np.uint64(bits)
        code |= by[todo].astype(np.uint64)
    order = np.argsort(code)
    code, first = code[order], bucket[todo[order]]
    new = np.ones(len(order), bool)
    new[1:] = code[1:] != code[:-1]
    head = np.ones(len(order), bool)
    head[1:] = first[1:] != first[:-1]
    at = np.arange(len(order))
    start = np.maximum.accumulate(np.where(head, at, 0))
    part = np.maximum.accumulate(np.where(new, at, 0))
    out = bucket.copy()
    out[todo[order]] = first + (part - start)
    return out


def window_buckets(text: np.ndarray, asked: np.ndarray, length: int = BYTES) -> np.ndarray:
    """Bucket of each position ``asked``: equal exactly where the next ``length`` bytes are equal.

    Windows must end within ``text``. A refinement looks up as many later offsets as fit into one number
    beside the bucket itself: two where the text is below 2 MB. The first ones refine all positions, as
    later ones look them up; the last cover the rest of the window and only sort what was asked for.
    """
    gram = min(GRAM, length)
    code = np.zeros(len(text), np.uint64)
    for i in range(gram):
        code <<= np.uint64(8)
        code[: len(text) - i] |= text[i:]
    order = np.argsort(code)
    sorted_code = code[order]
    new = np.ones(len(order), bool)
    new[1:] = sorted_code[1:] != sorted_code[:-1]
    bucket = np.empty(len(text), np.int64)
    bucket[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    depth, bits = gram, len(text).bit_length()
    looks = 64 // bits - 1
    while 2 * depth * (looks + 1) <= length:
        past = np.zeros(looks * depth, np.int64)  # no window that was asked for reaches there
        ahead = np.concatenate([bucket, past])
        bucket = refine(bucket, [ahead[i * depth : i * depth + len(text)] for i in range(1, looks + 1)], bits)
        depth *= looks + 1
    mine = bucket[asked]
    offsets = [*range(depth, length - depth, depth), length - depth] if depth < length else []
    for i in range(0, len(offsets), looks):
        mine = refine(mine, [bucket[asked + o] for o in offsets[i : i + looks]], bits)
    return mine


def repeats_in(
    contents: list[bytes], windows: np.ndarray, counts: np.ndarray, places: list[tuple], length: int = BYTES
) -> list[tuple[int, int, int, bool]]:
    """Spans ``(content, offset, windows, copies)`` of windows that also start at an earlier place: of the
    content's first place those whose bucket has an earlier one, of its other places those whose bucket
    has more than one, as the first place is in it."""
    sizes = np.array([len(c) for c in contents], np.int64)
    bases = np.cumsum(sizes) - sizes
    # contents in the order of their places
    order = np.lexsort(np.array(places, np.int64).reshape(-1, 3).T[::-1])
    row = np.repeat(np.arange(len(contents)), windows)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    mine = window_buckets(np.frombuffer(b"".join(contents), np.uint8), bases[row] + offset, length)
    before = np.empty(len(order), np.int64)  # windows of the contents whose place is earlier
    before[order] = np.cumsum(windows[order]) - windows[order]
    met = np.flatnonzero(np.bincount(mine, minlength=1)[mine] > 1)  # the others are alone in their bucket
    turn = met[np.argsort(mine[met] * np.int64(len(row) + 1) + before[row[met]] + offset[met])]
    again = np.zeros(len(row), bool)
    again[turn[1:]] = mine[turn[1:]] == mine[turn[:-1]]
    shared = (np.bincount(mine, counts[row], minlength=1)[mine] >= 2) & (counts[row] >= 2)
    return [(*r, False) for r in _runs(again, row, offset)] + [(*r, True) for r in _runs(shared, row, offset)]


def _runs(flagged: np.ndarray, row: np.ndarray, offset: np.ndarray) -> list[tuple[int, int, int]]:
    """Runs ``(content, offset, windows)`` of flagged windows, which do not cross contents."""
    edge, last = flagged.copy(), flagged.copy()
    together = flagged[:-1] & flagged[1:] & (row[1:] == row[:-1])
    edge[1:] &= ~together
    last[:-1] &= ~together
    starts, ends = np.flatnonzero(edge), np.flatnonzero(last)
    return list(zip(row[starts].tolist(), offset[starts].tolist(), (ends - starts + 1).tolist(), strict=True))


_VALUES = scrambled(np.arange(1, 257, dtype=np.uint64))


def _symbols(text: bytes) -> np.ndarray:
    return _VALUES[np.frombuffer(text, np.uint8)]


def method(length: int = BYTES, gram: int = 24) -> Method:
    return Method(
        length,
        min(gram, length),
        _symbols,
        bytes,
        lambda text, a, b: text[a:b],
        lambda *a: repeats_in(*a, length=length),
        keep_first=True,
    )


def deduplicated(docs: DataFrame, length: int = BYTES) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` for every row of ``docs`` (doc_id, text).

    Texts are UTF-8 bytes, null is empty. Every byte in a string of ``length`` bytes that also starts
    earlier, by id and then by place, is removed; strings are judged on the input and do not cross
    documents. ``n_spans`` counts maximal removed runs; ``kept`` is what remains, as bytes. Rows that
    repeat an id are documents of their own, in the order they are read; rows without an id come
    last. Other columns are not read, and an empty table gives no rows.
    """
    packed, spans = repeated(docs, method(length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in spanned(batches):
            n_bytes, n_removed, n_spans, digest, kept = [], [], [], [], []
            for text, starts, windows in found:
                n_bytes.append(len(text))
                runs = 0
                if len(starts):
                    gone = covered(len(text), starts, windows, length)
                    runs = int(gone[0]) + int(np.count_nonzero(gone[1:] & ~gone[:-1]))
                    text = np.frombuffer(text, np.uint8)[~gone].tobytes()
                n_removed.append(n_bytes[-1] - len(text))
                n_spans.append(runs)
                kept.append(text)
                digest.append(hashlib.sha256(text).hexdigest())
            columns = [pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)]
            yield pa.RecordBatch.from_arrays(
                [ids, *columns, pa.array(digest, pa.string()), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return with_spans(packed, spans).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
