"""Substring dedup: suffix automata of reference shards and matching statistics.

A reference shard is a set of text pieces that share anchors (see ``repeats``). Its suffix automaton
accepts every run of words of the shard and knows how often each run occurs. The pieces are
streamed through it, and the states they pass give their matching statistics: for every word, the length
of the longest run ending there that the shard holds twice or more. Where that reaches the threshold, the window
ending there is repeated; maximal spans of such windows are removed.

Every automaton goes to the pieces that can match it, not to all documents: broadcasting all
automata would make the work grow with the square of the corpus.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wattspark.llm.common import hashes
from wattspark.llm.repeats import Method, covered, repeated, spanned, with_spans

WORDS = 35


class Automaton:
    """Suffix automaton of several sequences, each with a number of occurrences."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link: list[int] = [-1]
        self.longest: list[int] = [0]
        self.count: list[int] = [0]

    def _state(self, longest: int, link: int, edges: dict) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.longest.append(longest)
        self.count.append(0)
        return len(self.next) - 1

    def _split(self, p: int, q: int, word) -> int:
        """State of the runs that reach ``q`` from ``p`` and its suffixes, which are shorter than q's."""
        if self.longest[q] == self.longest[p] + 1:
            return q
        part = self._state(self.longest[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = part
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = part
            p = self.link[p]
        return part

    def add(self, words: list, times: int) -> list[int]:
        """Add a sequence; gives the state of each of its prefixes, which is the longest run of that state
        and so stays there when states are split."""
        following, link, longest, count = self.next, self.link, self.longest, self.count
        last, path = 0, []
        for word in words:
            state = following[last].get(word)
            if state is None:
                state = len(following)
                following.append({})
                link.append(0)
                longest.append(longest[last] + 1)
                count.append(0)
                p = last
                while p >= 0 and word not in following[p]:
                    following[p][word] = state
                    p = link[p]
                if p >= 0:
                    q = following[p][word]
                    link[state] = q if longest[q] == longest[p] + 1 else self._split(p, q, word)
            elif longest[state] != longest[last] + 1:
                state = self._split(last, state, word)
            last = state
            count[last] += times
            path.append(last)
        return path

    def finish(self) -> list[int]:
        """Add up occurrences; for every state, the longest suffix of its runs that occurs twice."""
        order = np.argsort(self.longest, kind="stable").tolist()
        link, longest, count = self.link, self.longest, self.count
        for s in reversed(order[1:]):
            count[link[s]] += count[s]
        often = [0] * len(order)
        for s in order[1:]:
            often[s] = longest[s] if count[s] >= 2 else often[link[s]]
        return often

    def read(self, words: list) -> list[int]:
        """The states of a sequence's prefixes, of one that was added."""
        out, state = [], 0
        for word in words:
            state = self.next[state][word]
            out.append(state)
        return out

    @staticmethod
    def statistics(path: list[int], often: np.ndarray) -> np.ndarray:
        """For every word of a sequence, given by its states, the longest run ending there that occurs twice."""
        return np.minimum(often[path], np.arange(1, len(path) + 1))


def repeats_in(
    contents: list[bytes], windows: np.ndarray, counts: np.ndarray, places: list[tuple], length: int = WORDS
) -> list[tuple[int, int, int, bool]]:
    """Spans ``(content, offset, windows, copies)`` of repeated windows, by the matching statistics; where a
    content occurs more than once, for its first place and for the others."""
    automaton, number = Automaton(), {}
    paths = []
    watched = gc.isenabled()
    gc.disable()  # many small tables without cycles
    try:
        for content, n in zip(contents, counts.tolist(), strict=True):
            words = [number.setdefault(w, len(number)) for w in content.split()]
            paths.append(automaton.add(words, n))
    finally:
        if watched:
            gc.enable()
    often = np.array(automaton.finish())
    out = []
    for i, path in enumerate(paths):
        hit = automaton.statistics(path, often)[length - 1 :] >= length
        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]])))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            out += [(i, a, b - a, copies) for copies in ((False, True) if counts[i] >= 2 else (False,))]
    return out


def _symbols(text: bytes) -> np.ndarray:
    words = text.split()
    return hashes(words, len(words))


def method(length: int = WORDS, gram: int = 6) -> Method:
    return Method(
        length,
        min(gram, length),
        _symbols,
        bytes.split,
        lambda words, a, b: b" ".join(words[a:b]),
        lambda *a: repeats_in(*a, length=length),
        keep_first=False,
    )


def deduplicated(docs: DataFrame, length: int = WORDS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, kept`` for every row of ``docs`` (doc_id, text).

    Words are runs without ASCII white space. Every word in a window of ``length`` words that also
    starts elsewhere, in the same text or another, is removed; windows are judged on the input.
    ``kept`` is the remaining words joined by one blank. Null and empty texts have no words. Rows
    that repeat an id are documents of their own, so equal ones lose all that is long enough; a
    null id stays null. Other columns are not read, and an empty table gives no rows.
    """
    packed, spans = repeated(docs, method(length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in spanned(batches):
            n_words, n_removed, digest, kept = [], [], [], []
            for text, starts, windows in found:
                words = text.split()
                n_words.append(len(words))
                if len(starts):
                    gone = covered(len(words), starts, windows, length)
                    words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
                digest.append(hashlib.sha256(kept[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    ids,
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return with_spans(packed, spans).mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    )
