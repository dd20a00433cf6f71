"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as its own embedding next to the mean embedding of its character trigrams, so that
unseen spellings still say something. A text is cut into overlapping windows; a window is read by a
gated recurrent unit in either direction, attention pools the states, and a linear layer gives the
window's logit. The document's logit is the mean of its windows' logits, weighted by a softmax of
them: close to the largest, and smooth enough to train on document labels.

Tasks score all windows of whole texts. The inputs of the recurrence are computed once for each
distinct word of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattspark.llm.common import PLAIN, bytes_of, hashes, scrambled

DRAWN = 3  # ids drawn for each document that is to train

Params = dict[str, np.ndarray]


@dataclass(frozen=True)
class Settings:
    """``docs_per_label`` and ``max_chars`` bound the training sample: longer documents do not
    train. Scoring covers whole texts of any length."""

    docs_per_label: int = 1800
    max_chars: int = 3000
    words: int = 1 << 14
    word_dim: int = 12
    chars: int = 1 << 12
    char_dim: int = 6
    hidden: int = 8
    window: int = 24
    stride: int = 12
    sharpness: float = 2.0  # of the softmax over windows
    epochs: int = 8
    docs_per_step: int = 16
    rate: float = 0.01
    spread: float = 0.01  # of the embeddings to begin with: words that did not train keep theirs
    calibration_share: float = 0.25
    seed: int = 5


@dataclass
class Batch:
    """Texts as windows over the distinct words of the batch; index 0 is no word."""

    word: np.ndarray  # bucket of each distinct word
    char: np.ndarray  # buckets of the trigrams of all distinct words, one after the other
    char_of: np.ndarray  # the distinct word of each trigram
    windows: np.ndarray  # windows x window length
    doc: np.ndarray  # document of each window
    docs: int


def layout(texts: list[bytes], s: Settings) -> Batch:
    known: dict[bytes, int] = {b"": 0}
    rows, doc = [], []
    for d, text in enumerate(texts):
        ids = [known.setdefault(w, len(known)) for w in text.translate(PLAIN).split()]
        starts = range(0, max(1, len(ids) - s.window + s.stride), s.stride)
        padded = np.zeros(starts[-1] + s.window, np.int32)
        padded[: len(ids)] = ids
        rows.append(np.lib.stride_tricks.sliding_window_view(padded, s.window)[:: s.stride])
        doc.append(np.full(len(starts), d, np.int64))
    words = list(known)
    laid = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8).astype(np.uint32)
    length = np.fromiter(map(len, words), np.int64, len(words)) + 2
    starts = np.cumsum(length) - length
    n = np.maximum(length - 2, 1)
    char_of = np.repeat(np.arange(len(words)), n)
    at = np.arange(len(char_of)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
    end = len(laid) - 1
    code = (laid[at] * np.uint32(31) + laid[np.minimum(at + 1, end)]) * np.uint32(0x9E3779B1)
    code = (code + laid[np.minimum(at + 2, end)]) * np.uint32(0x85EBCA6B)
    word = scrambled(hashes(words, len(words))) & np.uint64(s.words - 1)
    return Batch(
        word.astype(np.int64),
        ((code >> np.uint32(13)) & np.uint32(s.chars - 1)).astype(np.int64),
        char_of,
        np.concatenate(rows) if rows else np.zeros((0, s.window), np.int32),
        np.concatenate(doc) if doc else np.zeros(0, np.int64),
        len(texts),
    )


def initial(s: Settings) -> Params:
    rng = np.random.default_rng(s.seed)
    d, h = s.word_dim + s.char_dim, s.hidden
    shapes = {
        "word": ((s.words, s.word_dim), s.spread),
        "char": ((s.chars, s.char_dim), s.spread),
        "in": ((d, 6 * h), d**-0.5),  # both directions, three gates each
        "in_bias": ((6 * h,), 0.0),
        "again": ((2, h, 3 * h), h**-0.5),
        "look": ((2 * h,), 0.3),
        "out": ((2 * h,), 0.3),
        "out_bias": ((1,), 0.0),
    }
    return {k: rng.normal(0, 1, shape).astype(np.float32) * np.float32(std) for k, (shape, std) in shapes.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _inputs(p: Params, b: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Input vectors of the distinct words, trigrams per word, and the recurrence's inputs."""
    n = np.bincount(b.char_of, minlength=len(b.word)).astype(np.float32)[:, None]
    sums = np.stack(
        [np.bincount(b.char_of, p["char"][b.char, i], len(b.word)) for i in range(p["char"].shape[1])], axis=1
    )
    x = np.concatenate([p["word"][b.word], (sums / n).astype(np.float32)], axis=1)
    return x, n, x @ p["in"] + p["in_bias"]


def _read(p: Params, given: np.ndarray, windows: np.ndarray, side: int, keep: bool):
    """States of one direction, steps x windows x hidden, in the order of the text."""
    steps, h = windows.shape[1], p["again"].shape[1]
    again = p["again"][side]
    state = np.zeros((len(windows), h), np.float32)
    states = np.empty((steps, len(windows), h), np.float32)
    given = np.ascontiguousarray(given[:, side * 3 * h : (side + 1) * 3 * h])
    trace = []
    for t in range(steps) if side == 0 else range(steps - 1, -1, -1):
        at = windows[:, t]
        x = given[at]
        there = (at > 0)[:, None]
        u = state @ again
        gates = _sigmoid(x[:, : 2 * h] + u[:, : 2 * h])
        z, r = gates[:, :h], gates[:, h:]
        new = np.tanh(x[:, 2 * h :] + r * u[:, 2 * h :])
        after = np.where(there, new + z * (state - new), state)
        if keep:
            trace.append((t, state, z, r, new, u[:, 2 * h :], there))
        state = after
        states[t] = state
    return states, trace


def _forward(p: Params, b: Batch, keep: bool = False):
    """Logit of every window, and what the backward pass needs."""
    x, n, given = _inputs(p, b)
    sides = [_read(p, given, b.windows, side, keep) for side in (0, 1)]
    states = np.concatenate([s for s, _ in sides], axis=2)
    look = states @ p["look"]
    look = np.where(b.windows.T > 0, look, -30.0)
    share = np.exp(look - look.max(axis=0))
    share /= share.sum(axis=0)
    pooled = (share[:, :, None] * states).sum(axis=0)
    logits = pooled @ p["out"] + p["out_bias"]
    return logits, (x, n, sides, states, share, pooled)


def pool(logits: np.ndarray, doc: np.ndarray, docs: int, sharpness: float) -> tuple[np.ndarray, np.ndarray]:
    """Document logits, and the weight of each window in them."""
    top = np.full(docs, -np.inf)
    np.maximum.at(top, doc, logits)
    e = np.exp(sharpness * (logits - top[doc]))
    share = e / np.bincount(doc, e, docs)[doc]
    return np.bincount(doc, share * logits, docs), share


def _backward(p: Params, b: Batch, kept, d_logit: np.ndarray) -> Params:
    """Gradients for given gradients of the windows' logits."""
    x, n, sides, states, share, pooled = kept
    h = p["again"].shape[1]
    g: Params = {"out": pooled.T @ d_logit, "out_bias": d_logit.sum(keepdims=True)}
    d_pooled = d_logit[:, None] * p["out"]
    d_share = (states * d_pooled).sum(axis=2)
    d_look = share * (d_share - (share * d_share).sum(axis=0))
    g["look"] = np.einsum("tb,tbh->h", d_look, states)
    d_states = share[:, :, None] * d_pooled + d_look[:, :, None] * p["look"]
    d_given = np.zeros((len(b.word), 6 * h), np.float32)
    g["again"] = np.zeros_like(p["again"])
    for side, (_, trace) in enumerate(sides):
        again = p["again"][side]
        carry = np.zeros((len(b.windows), h), np.float32)
        flows, places = [], []
        for t, before, z, r, new, u, there in reversed(trace):
            total = d_states[t, :, side * h : (side + 1) * h] + carry
            d = total * there
            d_new = d * (1 - z) * (1 - new * new)
            d_z = d * (before - new) * z * (1 - z)
            d_r = d_new * u * r * (1 - r)
            flow = np.concatenate([d_z, d_r, d_new * r], axis=1)
            g["again"][side] += before.T @ flow
            carry = total * ~there + d * z + flow @ again.T
            flow[:, 2 * h :] = d_new
            flows.append(flow)
            places.append(b.windows[:, t])
        flow, place = np.concatenate(flows), np.concatenate(places)
        for i in range(3 * h):
            d_given[:, side * 3 * h + i] = np.bincount(place, flow[:, i], len(b.word))
    g["in"], g["in_bias"] = x.T @ d_given, d_given.sum(axis=0)
    d_x = d_given @ p["in"].T
    w = p["word"].shape[1]
    g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
    np.add.at(g["word"], b.word, d_x[:, :w])
    np.add.at(g["char"], b.char, (d_x[:, w:] / n)[b.char_of])
    return g


@dataclass
class Model:
    params: Params
    scale: float
    shift: float
    settings: Settings = field(default_factory=Settings)

    def logits(self, texts: list[bytes], windows_at_once: int = 16_384) -> np.ndarray:
        """Document logits of whole texts; windows are read in pieces, so memory is bounded."""
        s = self.settings
        b = layout(texts, s)
        found = np.empty(len(b.doc), np.float32)
        for at in range(0, len(b.doc), windows_at_once):
            piece = b.windows[at : at + windows_at_once]
            used, index = np.unique(piece, return_inverse=True)
            if used[0] != 0:
                used, index = np.concatenate([[0], used]), index + 1
            found[at : at + windows_at_once] = self._piece(b, used, index.reshape(piece.shape))
        return pool(found, b.doc, b.docs, s.sharpness)[0] if b.docs else np.zeros(0)

    def _piece(self, b: Batch, used: np.ndarray, windows: np.ndarray) -> np.ndarray:
        place = np.full(len(b.word), -1)
        place[used] = np.arange(len(used))
        chars = place[b.char_of] >= 0
        part = Batch(b.word[used], b.char[chars], place[b.char_of[chars]], windows, np.zeros(0), 0)
        return _forward(self.params, part)[0]

    def score(self, texts: list[bytes]) -> np.ndarray:
        return _sigmoid(self.scale * self.logits(texts) + self.shift)


def train(samples: list[tuple[int, int, bytes]], settings: Settings, prior: float = 0.5) -> Model:
    """Model from ``(id, label, text)`` samples, in any order; ``prior`` is the share of label 1.

    A part of the sample fits the two numbers that turn logits into probabilities, weighted by the
    prior. Without samples of both labels every score is the prior.
    """
    s = settings
    samples = sorted(samples)
    labels = np.array([label for _, label, _ in samples], np.float64)
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    p = initial(s)
    if not samples or labels.min() == labels.max():
        return Model(p, 0.0, float(np.log(prior / (1 - prior))), s)
    rng = np.random.default_rng(s.seed)
    held = rng.random(len(samples)) < s.calibration_share
    if len(samples) < 40:
        held[:] = False
    fit = np.flatnonzero(~held)
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    step, steps = 0, s.epochs * -(-len(fit) // s.docs_per_step)
    for _ in range(s.epochs):
        order = rng.permutation(fit)
        for at in range(0, len(order), s.docs_per_step):
            step += 1
            some = order[at : at + s.docs_per_step]
            b = layout([samples[i][2] for i in some], s)
            logits, kept = _forward(p, b, keep=True)
            total, share = pool(logits, b.doc, b.docs, s.sharpness)
            d_doc = (_sigmoid(total) - labels[some]) / len(some)
            d_window = d_doc[b.doc] * share * (1 + s.sharpness * (logits - total[b.doc]))
            grads = _backward(p, b, kept, d_window.astype(np.float32))
            rate = s.rate * (1 - (step - 1) / steps)
            for k, g in grads.items():  # Adam
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                change = (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
                p[k] -= (rate * change).astype(np.float32)
    model = Model(p, 1.0, 0.0, s)
    judge = np.flatnonzero(held) if len(set(labels[held])) == 2 else fit
    model.scale, model.shift = _calibrate(model.logits([samples[i][2] for i in judge]), labels[judge], prior)
    return model


def _calibrate(logits: np.ndarray, labels: np.ndarray, prior: float) -> tuple[float, float]:
    """Logistic fit of the labels on the logits, classes weighted to the prior.

    The likeliest of a row of scales; each with the shift that makes the mean score the prior, found
    by bisection.
    """
    weight = np.where(labels == 1, prior / labels.mean(), (1 - prior) / (1 - labels.mean()))
    best = (np.inf, 1e-3, float(np.log(prior / (1 - prior))))
    for scale in np.geomspace(0.02, 5, 49):
        x = scale * logits
        low, high = -60.0 - x.max(), 60.0 - x.min()
        for _ in range(60):
            shift = (low + high) / 2
            over = (weight * (_sigmoid(x + shift) - labels)).sum() > 0
            low, high = (low, shift) if over else (shift, high)
        loss = (weight * (np.logaddexp(0, x + shift) - labels * (x + shift))).sum()
        best = min(best, (float(loss), float(scale), float(shift)))
    return best[1:]


def fit(docs: DataFrame, labels: DataFrame, settings: Settings | None = None) -> Model:
    """Train on a bounded sample of ``docs`` (doc_id, text) that ``labels`` (doc_id, label) marks 0 or 1.

    Of each label a share is drawn by the hash of the id that leaves ``DRAWN * docs_per_label`` ids on
    average; so few are sent to the documents, and the texts need not be shuffled. Of those found,
    texts up to ``max_chars`` train, ``docs_per_label`` per label. Rows with nulls do not train.
    """
    s = settings or Settings()
    marked = labels.select(F.col("doc_id").cast("long").alias("id"), F.col("label").cast("int").alias("label"))
    marked = marked.where("id IS NOT NULL AND label IN (0, 1)")
    sizes = {r["label"]: r["count"] for r in marked.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return train([], s, float(next(iter(sizes), 0)))
    wanted = DRAWN * s.docs_per_label
    share = F.when(F.col("label") == 1, wanted / sizes[1]).otherwise(wanted / sizes[0])
    drawn = F.pmod(F.xxhash64(F.lit(s.seed), "id"), F.lit(1 << 30)) / float(1 << 30)
    few = marked.where(drawn < share).limit(4 * wanted)  # the bound that the broadcast rests on
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.length("text") <= s.max_chars)
    found = rows.join(F.broadcast(few), F.col("doc_id") == F.col("id"))
    order = F.xxhash64("doc_id", F.lit(s.seed + 1))
    samples = []
    for label in (0, 1):  # a top list, so each task hands over no more than is wanted
        best = found.where(F.col("label") == label).orderBy(order, "doc_id").limit(s.docs_per_label)
        samples += [(r["doc_id"], r["label"], r["text"].encode()) for r in best.collect()]
    return train(samples, s, sizes[1] / (sizes[0] + sizes[1]))


def scores(docs: DataFrame, model: Model, docs_at_once: int = 256) -> DataFrame:
    """``(doc_id, score)`` of every whole text, score the probability of label 1.

    Null and empty texts are read as one window without words. Equal texts get equal scores, rows
    that repeat an id each get their row, and other columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = sent.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [m.score(texts[at : at + docs_at_once]) for at in range(0, len(texts), docs_at_once)]
            score = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score.astype(np.float64))], ["doc_id", "score"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), bytes_of(F.col("text")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")
