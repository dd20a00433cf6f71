"""Language-model scoring by a hashed maximum-entropy model.

A word's probability is that of its class given the words before it, times that of the word within
its class, given the same. Both are softmaxes over sums of weights: of the word before, of the two
words before together (n-grams), and of the second word before by itself (a skip). Each
of these contexts is hashed to one of ``2 ** bits`` rows of weights.

1. Words are counted over all training documents. Counts are kept in a table; those of frequent words,
   a bounded number, are also broadcast. Rarer ones are looked up by a join.
2. The most frequent words make the classes, by what stands before them: neighbours are counted over all
   training documents, and the words are halved along the leading direction of their counts until there
   are as many parts as classes. All other words are one more class, within which a word has its share
   of counts, one added, and one share is left for words never seen. So all probabilities add up to one.
3. Training starts from the counts. In each round the tasks take gradient steps over their training
   documents of that round, every document in one of the rounds, and the mean of their updates, by
   tokens, is the next round's model.
4. Scoring sums up whole texts in batches of tokens, gathering only the rows that occur.

A word counts alike wherever it is; rows of one text never meet in a group, and tables are joined by
word with one row per chunk of text, so a word that is everywhere is no hot key.
"""

from __future__ import annotations

import copy
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from wattspark.llm.common import gathered, hashes, written

END = " "  # stands for the end of a text among the words, none of which has a blank
FLOOR = -30.0  # least logit below the largest: no probability is zero, and none so small that it slows arithmetic
SLICE = 1 << 20  # bytes of token numbers whose contexts are in memory
CHUNK = 8 << 20  # bytes of text whose words are counted together and whose documents have one chunk's number
PART = 2 << 20  # bytes of text that are cut into words at once, which takes many times their size


@dataclass(frozen=True)
class Settings:
    frequent: int = 1 << 19  # words whose counts are broadcast, at most
    classes: int = 32  # a power of two
    width: int = 64  # words in a class, at most
    neighbours: int = 64  # most frequent words that are counted before a word to make the classes
    bits: int = 13
    rounds: int = 4
    tokens_per_task: int = 4_000_000  # in training: a task's update is as large as the model
    batch: int = 8192
    rate: float = 0.15


# Words -----------------------------------------------------------------------------------------


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one after another, with A-Z lower-cased; and how many each has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string()).fill_null("")))
    words = pc.list_flatten(lists)
    filled = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    sizes = pc.list_value_length(lists).to_numpy()
    ends = np.concatenate([[0], np.cumsum(filled)])[np.cumsum(sizes)]
    return words.filter(pa.array(filled)), np.diff(ends, prepend=0)


def counted(texts: DataFrame) -> DataFrame:
    """``word, n``: occurrences in the column ``text``, with the texts' ends as ``END``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in gathered(batches, "text", CHUNK):
            parts = [split(part.column("text"))[0] for part in gathered([chunk], "text", PART)]
            found = pc.value_counts(pa.chunked_array(parts, pa.string()))
            end = pa.array([END]), pa.array([chunk.num_rows], pa.int64())
            columns = [pa.concat_arrays([found.field(i), end[i]]) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n"])

    return texts.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Words:
    """Frequent words, the end first and then by falling count, with their counts; and all tokens and words."""

    words: pa.Array
    counts: np.ndarray
    tokens: int
    distinct: int
    least: int  # every word that occurs so often is among them


def frequent(counts: DataFrame, most: int) -> Words:
    """At most ``most`` words: all whose count reaches a bound, which a histogram of the counts gives."""
    total = counts.agg(F.sum("n").alias("n"), F.count("*").alias("k")).first()
    step = F.floor(F.log2("n") * 8).cast("int")
    histogram = counts.where(F.col("word") != END).groupBy(step.alias("step")).agg(F.count("*").alias("k"), F.min("n").alias("least"))
    left, least = most, (1 << 62)
    for row in sorted(histogram.collect(), reverse=True):  # eight rows for each doubling of the corpus
        left -= row["k"]
        if left < 0:
            break
        least = row["least"]
    found = counts.where((F.col("n") >= least) | (F.col("word") == END)).toArrow().combine_chunks()
    words, n = found.column("word").combine_chunks(), found.column("n").to_numpy()
    is_end = pc.equal(words, END).to_numpy(zero_copy_only=False)
    order = np.lexsort((words.to_numpy(zero_copy_only=False).astype(object), -n, ~is_end)) if len(words) else np.empty(0, int)
    if not len(words):  # nothing to learn from
        return Words(pa.array([END]), np.zeros(1, np.int64), 0, 0, least)
    return Words(words.take(pa.array(order)), n[order], total["n"], total["k"], least)


class Places:
    """Where words are among the frequent ones, by their hashes, which are sorted once and not in every task."""

    def __init__(self, words: pa.Array):
        self.words = words
        cuts = (words.slice(i, 1 << 16) for i in range(0, len(words), 1 << 16))
        hashed = np.concatenate([hashes(cut.to_numpy(zero_copy_only=False), len(cut)) for cut in cuts])
        self.order = np.argsort(hashed, kind="stable").astype(np.int32)
        self.hashed = hashed[self.order]

    def of(self, words: pa.Array, spelled: list[str]) -> np.ndarray:
        """The place of each word, which is also given as ``spelled``; -1 where it is not frequent."""
        hashed = hashes(spelled, len(spelled))
        turn = np.argsort(hashed)  # what is looked up next is near in memory then
        at = np.empty(len(hashed), np.int64)
        at[turn] = np.minimum(np.searchsorted(self.hashed, hashed[turn]), len(self.hashed) - 1)
        met = np.flatnonzero(self.hashed[at] == hashed)
        place = self.order[at[met]].astype(np.int64)
        same = pc.equal(words.take(pa.array(met)), self.words.take(pa.array(place))).to_numpy(zero_copy_only=False)
        out = np.full(len(words), -1, np.int64)
        out[met[same]] = place[same]
        other = met[~same]
        if len(other):  # words whose hash another one has
            found = pc.index_in(words.take(pa.array(other)), value_set=self.words)
            out[other] = found.fill_null(-1).to_numpy()
        return out


_NUMBERED = (
    "chunk long, doc int, doc_id long, held_out boolean, n_tokens long, ids binary, known_log double, outside_log double, "
    "n_known long, word string, docs array<int>, times array<int>"
)


def numbered(docs: DataFrame, known: Words, inside: int) -> DataFrame:
    """Texts as numbers, chunk by chunk; rows are documents or rare words of a chunk.

    A document has the number of each token (of frequent words their place, of others a hash beyond
    them), the sum of log10(count + 1) over its frequent tokens, and over those that are not among the
    first ``inside``. A word's row has the documents of the chunk that hold it, and how often.
    """
    sent = docs.sparkSession.sparkContext.broadcast((Places(known.words), np.log10(known.counts + 1.0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for rows in gathered(batches, "text", CHUNK):
            yield from _chunk(rows, *sent.value, inside, chunk)
            chunk += 1

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, _NUMBERED)


def _chunk(rows: pa.RecordBatch, places: Places, logs: np.ndarray, inside: int, chunk: int) -> Iterator[pa.RecordBatch]:
    """Rows of a chunk's documents, part by part, and of its rare words."""
    first, held = 0, []
    for part in gathered([rows], "text", PART):
        texts, rare = _part(part, places, logs, inside, chunk, first)
        yield texts
        held.append(rare)
        first += part.num_rows
    if any(len(words) for words, *_ in held):
        yield _rare(held, chunk)


def _part(rows: pa.RecordBatch, places: Places, logs: np.ndarray, inside: int, chunk: int, first: int):
    """Rows of some documents of a chunk, of which the first is its document ``first``; and their rare words with, for
    each document that holds one, the number of the word among these, the document, and how often it does."""
    flat, n = split(rows.column("text"))
    coded = flat.dictionary_encode()
    spelled = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # far quicker than ``to_pylist``
    place = places.of(coded.dictionary, spelled)
    rare = np.flatnonzero(place < 0)
    hashed = np.fromiter((xxhash.xxh32_intdigest(spelled[i]) & 0xFFFFF for i in rare.tolist()), np.int64, len(rare))
    number = place.copy()
    number[rare] = len(logs) + hashed
    code = coded.indices.to_numpy()
    doc = np.repeat(np.arange(len(n)), n)
    ends = np.cumsum(n + 1)
    ids = np.zeros(int(ends[-1]), np.int32)
    inner = np.ones(len(ids), bool)
    inner[ends - 1] = False
    ids[inner] = number[code]
    hit = place[code]
    at = np.flatnonzero(hit >= 0)
    log = logs[hit[at]]
    known_log = np.bincount(doc[at], log, len(n)) + logs[0]
    outside_log = np.bincount(doc[at], log * (hit[at] >= inside), len(n))
    raw, starts = ids.tobytes(), [0, *ends.tolist()]
    columns = {
        "chunk": pa.array(np.full(len(n), chunk)),
        "doc": pa.array(np.arange(first, first + len(n), dtype=np.int32)),
        "doc_id": rows.column("doc_id"),
        "held_out": rows.column("held_out"),
        "n_tokens": pa.array(n + 1, pa.int64()),
        "ids": pa.array([raw[4 * a : 4 * b] for a, b in zip(starts, starts[1:])], pa.binary()),
        "known_log": pa.array(known_log.astype(float)),
        "outside_log": pa.array(outside_log.astype(float)),
        "n_known": pa.array(np.bincount(doc[at], minlength=len(n)) + int(logs[0] > 0)),
    }
    at = np.flatnonzero(hit < 0)
    both, times = np.unique(code[at].astype(np.int64) * len(n) + doc[at], return_counts=True)
    word, within = np.divmod(both, len(n))
    found = coded.dictionary.take(pa.array(rare)), np.searchsorted(rare, word), within + first, times
    return _row_batch(columns, len(n)), found


_KINDS = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


def _row_batch(columns: dict[str, pa.Array], n: int) -> pa.RecordBatch:
    names = dict(c.split() for c in _NUMBERED.split(", "))
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(n, _KINDS[k])) for c, k in names.items()], list(names))


def _rare(held: list[tuple], chunk: int) -> pa.RecordBatch:
    """A row for every rare word of a chunk, whose parts found ``held``."""
    words, number, docs, times = zip(*held)
    coded = pa.concat_arrays(words).dictionary_encode()
    before = np.cumsum([0, *map(len, words[:-1])])
    word = coded.indices.to_numpy()[np.concatenate([n + b for n, b in zip(number, before)])]
    order = np.argsort(word, kind="stable")  # the documents ascend
    n = len(coded.dictionary)
    offsets = pa.array(np.searchsorted(word[order], np.arange(n + 1)), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(x)[order].astype(np.int32))) for x in (docs, times)]
    columns = {"chunk": pa.array(np.full(n, chunk)), "word": coded.dictionary, "docs": lists[0], "times": lists[1]}
    return _row_batch(columns, n)


# The model -------------------------------------------------------------------------------------


def before(ids: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """For every token the one ``k`` before it in its text, -1 where there is none."""
    out = np.full(len(ids), -1, np.int64)
    out[k:] = ids[: len(ids) - k]
    for j in range(k):  # also in texts shorter than k, what lies before belongs to another text
        at = starts + j
        out[at[at < np.append(starts[1:], len(ids))]] = -1
    return out


def _hashed(bits: int, kind: int, *parts: np.ndarray) -> np.ndarray:
    h = np.full(len(parts[0]), kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
    for p in parts:
        h = (h ^ p.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def bisected(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    """Rows in ``parts`` groups of nearly one size: halves along the leading direction, and again."""
    groups = [np.arange(len(vectors))]
    while len(groups) < parts:
        halves = []
        for g in groups:
            x = vectors[g] - vectors[g].mean(axis=0) if len(g) else vectors[g]
            along = x @ np.linalg.eigh(x.T @ x)[1][:, -1] if len(g) > 1 else np.zeros(len(g))
            order = g[np.argsort(along, kind="stable")]
            halves += [order[: (len(g) + 1) // 2], order[(len(g) + 1) // 2 :]]
        groups = halves
    return groups


class Model:
    """Weights, and the class and slot of each word that has one. ``theta`` holds all weights in a row:
    class rows, class bias, word rows, word biases; ``seen`` the mean squared updates of rows."""

    def __init__(self, s: Settings, groups: list[np.ndarray], counts: np.ndarray, outside: float):
        self.s, self.inside = s, len(counts)
        self.of, self.slot = np.empty(len(counts), np.int64), np.empty(len(counts), np.int64)
        rows, c, w = 1 << s.bits, s.classes, max(1, *map(len, groups))
        share, within = np.full(c + 1, 0.5), np.full((c, w), -1e4)
        for i, g in enumerate(groups):
            self.of[g], self.slot[g] = i, np.arange(len(g))
            if len(g):
                share[i] = counts[g].sum() + len(g)
                within[i, : len(g)] = np.log((counts[g] + 1.0) / share[i])
            else:
                share[i] = 0
        share[c] = outside
        with np.errstate(divide="ignore"):
            bias = np.maximum(np.log(share / share.sum()), -1e4)
        self.shapes = [(rows, c + 1), (c + 1,), (rows, w), (c, w)]
        zero = [np.zeros(np.prod(x)) for x in self.shapes]
        self.theta = np.concatenate([zero[0], bias, zero[2], within.ravel()]).astype(np.float32)
        self.seen = np.full(2 * rows, 1e-3, np.float32)
        self.outside = outside

    def copy(self) -> Model:
        out = copy.copy(self)
        # into new arrays: the type of one that came from the driver is equal to theirs but another object,
        # with which ``np.add.at`` takes a path thirty times slower
        out.theta, out.seen = (np.empty(len(x), np.float32) for x in (self.theta, self.seen))
        out.theta[:], out.seen[:] = self.theta, self.seen
        return out

    def parts(self) -> list[np.ndarray]:
        out, at = [], 0
        for shape in self.shapes:
            out.append(self.theta[at : at + int(np.prod(shape))].reshape(shape))
            at += int(np.prod(shape))
        return out

    def contexts(self, ids: np.ndarray, starts: np.ndarray):
        """Rows of the class contexts of every token, and the two words before it."""
        a, b = before(ids, starts, 1), before(ids, starts, 2)
        bits = self.s.bits
        return [_hashed(bits, 1, a), _hashed(bits, 2, a, b), _hashed(bits, 3, b)], (a, b)

    def places(self, ids: np.ndarray) -> np.ndarray:
        """Class of each token; the last class is of all words without one."""
        out = np.full(len(ids), self.s.classes, np.int64)
        inside = ids < self.inside
        out[inside] = self.of[ids[inside]]
        return out

    def _inner(self, ids, kind, pair):
        """Tokens with a class of their own, their classes, slots and context rows."""
        at = np.flatnonzero(kind < self.s.classes)
        k = kind[at]
        return at, k, self.slot[ids[at]], [_hashed(self.s.bits, 5 + i, p[at], k) for i, p in enumerate(pair)]

    def log_probabilities(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Natural logarithm of every token's probability; of words without a class, that of their class."""
        rows, pair = self.contexts(ids, starts)
        kind, out = self.places(ids), np.empty(len(ids))
        w1, b1, w2, b2 = self.parts()
        for x in range(0, len(ids), self.s.batch):
            cut = slice(x, x + self.s.batch)
            k = kind[cut]
            out[cut] = _chosen(_softmax(w1, b1, [r[cut] for r in rows]), k)
            at, own, slot, inner = self._inner(ids[cut], k, [p[cut] for p in pair])
            if len(at):
                out[x + at] += _chosen(_softmax(w2, b2[own], inner), slot)
        return out

    def train(self, ids: np.ndarray, starts: np.ndarray) -> None:
        """Gradient steps over the tokens, in batches; rows that were updated much move less."""
        rows, pair = self.contexts(ids, starts)
        kind = self.places(ids)
        w1, b1, w2, b2 = self.parts()
        seen1, seen2 = np.split(self.seen, 2)
        for x in range(0, len(ids), self.s.batch):
            cut = slice(x, x + self.s.batch)
            k, here = kind[cut], [r[cut] for r in rows]
            p = _softmax(w1, b1, here)
            p[np.arange(len(k)), k] -= 1
            for r in here:
                _step(w1, seen1, r, p, self.s.rate)
            at, own, slot, inner = self._inner(ids[cut], k, [q[cut] for q in pair])
            if len(at):
                p = _softmax(w2, b2[own], inner)
                p[np.arange(len(at)), slot] -= 1
                for r in inner:
                    _step(w2, seen2, r, p, self.s.rate)


def _softmax(weights: np.ndarray, bias: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    x = weights[rows[0]]
    for r in rows[1:]:
        x += weights[r]
    x += bias
    x -= x.max(axis=1, keepdims=True)
    np.maximum(x, FLOOR, out=x)
    np.exp(x, out=x)
    x /= x.sum(axis=1, keepdims=True)
    return x


def _chosen(p: np.ndarray, which: np.ndarray) -> np.ndarray:
    return np.log(np.maximum(p[np.arange(len(which)), which], 1e-30).astype(np.float64))


def _step(weights, seen, rows, gradient, rate) -> None:
    """One step on the rows that occur, each by the sum of its tokens' gradients."""
    row = np.flatnonzero(np.bincount(rows, minlength=len(weights)))
    place = np.empty(len(weights), np.int64)
    place[row] = np.arange(len(row))
    width = gradient.shape[1]
    total = np.zeros(len(row) * width, np.float32)
    np.add.at(total, (place[rows][:, None] * width + np.arange(width)).ravel(), gradient.ravel())
    total = total.reshape(len(row), width)
    seen[row] += np.einsum("ij,ij->i", total, total) / width
    weights[row] -= rate * total / np.sqrt(seen[row])[:, None]


# Distributed parts -----------------------------------------------------------------------------


def _sequences(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of a batch's texts, one after another, and where each text starts."""
    raw = batch.column("ids").to_pylist()
    sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // 4
    return np.frombuffer(b"".join(raw), np.int32).astype(np.int64), np.cumsum(sizes) - sizes


PIECE = 1 << 16  # numbers in a row of what is summed


def _pieces(values: np.ndarray, weight: float) -> pa.RecordBatch:
    parts = [values[i : i + PIECE] * np.float32(weight) for i in range(0, len(values), PIECE)]
    data = pa.array([p.astype(np.float32).tobytes() for p in parts], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.arange(len(parts), dtype=np.int32)), pa.array([float(weight)] * len(parts)), data], ["piece", "weight", "data"]
    )


def _summed(parts: DataFrame) -> tuple[np.ndarray, float]:
    """Sum of the tasks' vectors, which have a bounded length, and of their weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for piece, weight, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = sums.setdefault(piece, [0.0, 0.0])
                held[0] += weight
                held[1] = held[1] + np.frombuffer(data, np.float32).astype(np.float64)
        for piece, (weight, total) in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([piece], pa.int32()), pa.array([weight]), pa.array([total.tobytes()], pa.binary())], ["piece", "weight", "data"]
            )

    rows = parts.repartition("piece").mapInArrow(run, _PIECES).collect()  # as many as the model has pieces
    rows.sort()
    return np.concatenate([np.frombuffer(r["data"]) for r in rows] or [np.empty(0)]), rows[0]["weight"] if rows else 0.0


_PIECES = "piece int, weight double, data binary"


def _neighbours(train: DataFrame, inside: int, k: int) -> np.ndarray:
    """How often each of the first ``inside`` words has each of the first ``k`` one or two words before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(inside * k)
        for batch in gathered(batches, "ids", SLICE):
            ids, starts = _sequences(batch)
            for d in (1, 2):
                left = before(ids, starts, d)
                at = (ids < inside) & (left >= 0) & (left < k)
                total += np.bincount(ids[at] * k + left[at], minlength=inside * k)
        yield _pieces(total, 1.0)

    found, _ = _summed(train.mapInArrow(run, _PIECES))
    return found.reshape(inside, k) if len(found) else np.zeros((inside, k))


def fit(train: DataFrame, words: Words, s: Settings = Settings()) -> Model:
    """The model of training rows ``ids, round``; ``words`` are theirs."""
    inside = min(len(words.words), s.classes * s.width)
    rest = words.tokens - int(words.counts[:inside].sum()) + words.distinct - inside + 1
    tasks = max(1, -(-words.tokens // s.tokens_per_task))
    train = train.coalesce(tasks)
    context = _neighbours(train.select("ids"), inside, min(inside, s.neighbours))
    vectors = np.sqrt(context / np.maximum(context.sum(axis=1, keepdims=True), 1.0))
    model = Model(s, bisected(vectors, s.classes), words.counts[:inside], float(max(rest, 1)))
    for r in range(s.rounds):
        sent = train.sparkSession.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            start, own, tokens = sent.value, None, 0
            for batch in gathered(batches, "ids", SLICE):
                ids, starts = _sequences(batch)
                if len(ids):
                    own = own or start.copy()
                    own.train(ids, starts)
                    tokens += len(ids)
            if own is not None:
                moved = np.concatenate([own.theta - start.theta, own.seen - start.seen])
                yield _pieces(moved, tokens)

        moved, tokens = _summed(train.where(F.col("round") == r).select("ids").mapInArrow(run, _PIECES))
        if tokens:
            model = model.copy()
            model.theta += (moved[: len(model.theta)] / tokens).astype(np.float32)
            model.seen += (moved[len(model.theta) :] / tokens).astype(np.float32)
    return model


def scored(docs: DataFrame, held_out: Column, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Words are runs without ASCII white space, A-Z lower-cased, and every text ends with an end, also
    null and empty ones, which have nothing else. The rows where ``held_out`` is false are learnt from.
    ``base_score`` is the sum over tokens of log10((count + 1) / (tokens + distinct + 1)), ``score`` the
    model's log10 probability of the text. Without training rows all words are unknown and both are of
    the same uniform share. Every row is a text, whether its id is null, repeated or neither; other
    columns are not read, and an empty table gives no rows.
    """
    s = settings
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), F.col("text").cast("string").alias("text"))
    counts = written(counted(rows.where(~F.col("held_out"))), "counts")
    words = frequent(counts, s.frequent)
    inside = min(len(words.words), s.classes * s.width)
    table = written(numbered(rows, words, inside), "numbered")
    texts = table.where("word IS NULL").select(*(c.split()[0] for c in _NUMBERED.split(", ")[:9]))
    turn = F.pmod(F.xxhash64("chunk", "doc"), F.lit(s.rounds)).alias("round")
    model = fit(texts.where(~F.col("held_out")).select("ids", turn), words, s)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    base, outside = np.log10(words.tokens + words.distinct + 1), np.log10(model.outside)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in gathered(batches, "ids", SLICE):
            ids, starts = _sequences(batch)
            logs = m.log_probabilities(ids, starts) / np.log(10) - outside * (ids >= m.inside)
            sums = np.add.reduceat(logs, starts) if len(starts) else np.empty(0)
            sums += batch.column("outside_log").to_numpy()
            kept = [batch.column(c) for c in ("chunk", "doc", "doc_id", "held_out", "n_tokens", "n_known", "known_log")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sums)], [*_SCORED])

    found = texts.mapInArrow(run, ", ".join(f"{c} {k}" for c, k in _SCORED.items()))
    rare = table.where("word IS NOT NULL").select("chunk", "word", "docs", "times")
    rest = counts.where((F.col("n") < words.least) & (F.col("word") != END))
    held = rare.join(rest.hint("merge"), "word").select("chunk", F.log10(F.col("n") + 1).alias("log"), F.explode(F.arrays_zip("docs", "times")).alias("x"))
    added = held.groupBy("chunk", F.col("x.docs").alias("doc")).agg(
        F.sum(F.col("x.times") * F.col("log")).alias("rare_log"), F.sum(F.col("x.times")).alias("rare_known")
    )
    both = found.join(added.hint("merge"), ["chunk", "doc"], "left")
    log, more = F.coalesce("rare_log", F.lit(0.0)), F.coalesce("rare_known", F.lit(0).cast("long"))
    return both.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + more).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        (F.col("known_log") + log - F.col("n_tokens") * F.lit(float(base))).alias("base_score"),
        (F.col("inside_score") + log).alias("score"),
    )


_SCORED = {
    "chunk": "long",
    "doc": "int",
    "doc_id": "long",
    "held_out": "boolean",
    "n_tokens": "long",
    "n_known": "long",
    "known_log": "double",
    "inside_score": "double",
}
