"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its subwords (byte n-grams of its words, hashed into
a fixed table); a linear layer and softmax give the languages. Both are trained in numpy by
stochastic gradient descent. As averaging and the linear layer commute, the trained table is
multiplied out once: every subword then has one score per language, and a text's logits are the
mean of its subwords' scores.

Rejection is calibrated on documents that did not train: one temperature is fitted to them, and the
thresholds are what all but ``reject_share`` of those predicted correctly reach, in confidence and in
the share of subwords that training saw. Confidence alone does not tell a text of no learned language:
its subwords share buckets with trained ones, and some language is always likeliest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattspark.llm.common import LOWER, column

UNKNOWN = "und"
CODE_BITS = 24  # of a subword's hash; the upper ones give its bucket


@dataclass(frozen=True)
class Settings:
    """``docs_per_lang`` and ``chars_per_doc`` bound the training sample: the passage starts at a
    place drawn from the document's id. All else of the operator covers whole texts."""

    docs_per_lang: int = 800
    chars_per_doc: int = 1500
    max_langs: int = 500
    buckets: int = 1 << 16
    dim: int = 16
    sizes: tuple[int, ...] = (2, 3, 4)
    epochs: int = 6
    rate: float = 0.5
    boost: float = 30.0  # of the embeddings' steps, as a subword is a small share of a text
    calibration_share: float = 0.25
    reject_share: float = 0.0005
    reject_below: float = 0.5
    unseen_below: float = 0.4  # of the share of subwords seen in training, as reject_below
    seed: int = 7


def subwords(
    text: bytes, sizes: tuple[int, ...], head: bytes = b" ", tail: bytes = b" ", upto: int | None = None
) -> np.ndarray:
    """Hash of every byte n-gram of every word; a blank on either side belongs to the word.

    The words are laid out with one blank between them, ``head`` before and ``tail`` after, and n-grams
    with a blank inside left out. ``upto``: only those that begin in the first bytes of the layout.
    """
    words = text.translate(LOWER).split()
    if not words:
        return np.empty(0, np.uint32)
    laid = np.frombuffer(head + b" ".join(words) + tail, np.uint8)
    blanks = np.cumsum(laid == 32, dtype=np.int32)
    code = laid.astype(np.uint32)
    found = []
    for size in range(2, max(sizes) + 1):
        n = len(laid) - size + 1
        if n <= 0:
            break
        code = code[:n] * np.uint32(0x01000193) + laid[size - 1 :]
        if size in sizes:
            inside = blanks[size - 2 : size - 2 + n] == blanks[:n]
            if upto is not None:
                inside[upto:] = False
            mixed = (code[inside] ^ (code[inside] >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * size)
            found.append(mixed >> np.uint32(32 - CODE_BITS))
    return np.concatenate(found) if found else np.empty(0, np.uint32)


def bucket(codes: np.ndarray, buckets: int) -> np.ndarray:
    return (codes >> np.uint32(4)) & np.uint32(buckets - 1)


def n_seen(codes: np.ndarray, seen: np.ndarray) -> int:
    """How many of the hashes have their bit set."""
    return int(((seen[codes >> np.uint32(3)] >> (codes & np.uint32(7)).astype(np.uint8)) & 1).sum())


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # buckets x languages: embedding times linear layer
    bias: np.ndarray
    temperature: float
    threshold: float  # of the confidence
    seen: np.ndarray  # bit map of the subwords that trained
    coverage: float  # threshold of the share of subwords in it
    settings: Settings

    def predict(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language index, calibrated confidence and whether it is rejected, for every text."""
        logits, known = self._logits(texts)
        p = _softmax(logits / self.temperature)
        best = p.argmax(axis=1)
        sure = p[np.arange(len(best)), best]
        return best, sure, (sure < self.threshold) | (known < self.coverage)

    def _logits(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        s = self.settings
        out = np.zeros((len(texts), len(self.langs)), np.float64)
        known = np.zeros(len(texts))
        for row, text in enumerate(texts):
            n = 0
            for part, *ends in _parts(text, max(s.sizes)):
                codes = subwords(part, s.sizes, *ends)
                out[row] += np.ones(len(codes), np.float32) @ self.table[bucket(codes, s.buckets)]
                known[row] += n_seen(codes, self.seen)
                n += len(codes)
            out[row] /= max(n, 1)
            known[row] /= max(n, 1)
        return out + self.bias, known


def _parts(text: bytes, reach: int, size: int = 1 << 20) -> Iterator[tuple[bytes, bytes, bytes, int | None]]:
    """Pieces of a very long text, so that memory stays bounded, with the last arguments of ``subwords``.

    Pieces end at white space. Where there is none in ``size`` bytes, a piece goes on for the ``reach`` - 1
    bytes that its last n-grams need, and only n-grams that begin before the cut count: together the
    pieces have the n-grams of the whole text.
    """
    at, head = 0, b" "
    while len(text) - at > size:
        cut = max(text.rfind(c, at + 1, at + size) for c in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f"))
        if cut > at:
            yield text[at:cut], head, b" ", None
            at, head = cut, b" "
            continue
        cut = at + size
        more = text[cut : cut + reach - 1]
        whole = cut + reach - 1 >= len(text) or len(more.split()) != 1 or len(more.split()[0]) != len(more)
        first = text[at : at + 1].isspace()  # left out of the layout, but for the blank before a word
        yield text[at : cut + reach - 1], head, b" " if whole else b"", len(head) + size - first
        at, head = cut, b" " if text[cut : cut + 1].isspace() else b""
    yield text[at:], head, b" ", None


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(samples: list[tuple[int, str, bytes]], settings: Settings) -> Model:
    """Model from ``(id, language, passage)`` samples; the order of the samples does not matter.

    Without samples the model knows no language and every text is rejected.
    """
    s = settings
    samples = sorted(x for x in samples if x[2].split())
    langs = sorted({lang for _, lang, _ in samples})
    seen = np.zeros(1 << CODE_BITS, bool)
    if not langs:
        return Model([UNKNOWN], np.zeros((s.buckets, 1)), np.zeros(1), 1.0, 2.0, np.packbits(seen), 1.0, s)
    rng = np.random.default_rng(s.seed)
    index = {lang: i for i, lang in enumerate(langs)}
    held = rng.random(len(samples)) < s.calibration_share
    if held.all() or len(samples) < 20:
        held[:] = False
    bags, labels = [], []
    for (_, lang, text), apart in zip(samples, held, strict=True):
        codes = subwords(text, s.sizes)
        which, times = np.unique(bucket(codes, s.buckets), return_counts=True)
        bags.append((which, times / times.sum()))
        labels.append(index[lang])
        if not apart:
            seen[codes] = True
    bits = np.packbits(seen, bitorder="little")
    emb = rng.normal(0, 0.1, (s.buckets, s.dim))
    lin = rng.normal(0, 0.1, (s.dim, len(langs)))
    bias = np.zeros(len(langs))
    fit = np.flatnonzero(~held)
    steps, step = s.epochs * len(fit), 0
    for _ in range(s.epochs):
        for i in rng.permutation(fit):
            rate = s.rate * (1 - step / steps)
            step += 1
            which, share = bags[i]
            hidden = share @ emb[which]
            grad = _softmax((hidden @ lin + bias)[None])[0]
            grad[labels[i]] -= 1
            back = lin @ grad
            lin -= rate * np.outer(hidden, grad)
            bias -= rate * grad
            emb[which] -= rate * s.boost * share[:, None] * back
    table = emb @ lin
    judge = np.flatnonzero(held) if held.any() else fit
    logits = np.array([share @ table[which] for which, share in (bags[i] for i in judge)]) + bias
    truth = np.array([labels[i] for i in judge])
    model = Model(langs, table.astype(np.float32), bias, _temperature(logits, truth), 0.0, bits, 0.0, s)
    p = _softmax(logits / model.temperature)
    right = p.argmax(axis=1) == truth
    sure = np.sort(p.max(axis=1)[right])
    if len(sure):
        least = int(s.reject_share * len(sure))
        known = np.sort(model._logits([samples[i][2] for i in judge[right]])[1])
        model.threshold = float(min(s.reject_below, sure[least]))
        model.coverage = float(min(s.unseen_below, known[least]))
    return model


def _temperature(logits: np.ndarray, truth: np.ndarray) -> float:
    """The divisor of the logits under which the held-out labels are likeliest."""
    best = (np.inf, 1.0)
    for t in np.geomspace(0.25, 8, 41):
        p = _softmax(logits / t)[np.arange(len(truth)), truth]
        best = min(best, (float(-np.log(np.maximum(p, 1e-12)).mean()), float(t)))
    return best[1]


def fit(docs: DataFrame, settings: Settings | None = None) -> Model:
    """Train on a bounded sample of the labelled rows ``(doc_id, text, lang)`` given.

    Of each language a share is drawn by the hash of the id that leaves ``docs_per_lang``
    documents on average; a document gives a passage of ``chars_per_doc`` characters. Where ids repeat
    so much that twice the sample is drawn, the first by hash of id and language train. Rows
    without a language are left out; of more than ``max_langs`` the most frequent train. The
    sample is all that reaches the driver.
    """
    s = settings or Settings()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(s.max_langs).collect()
    samples = []
    if sizes:
        share = F.create_map(*(F.lit(x) for r in sizes for x in (r["lang"], s.docs_per_lang / r["count"])))
        drawn = F.pmod(F.xxhash64(F.lit(s.seed), "doc_id", "lang"), F.lit(1 << 30)) / float(1 << 30)
        place = F.pmod(F.xxhash64("doc_id", F.lit(s.seed + 1)), F.greatest(F.length("text") - s.chars_per_doc, F.lit(1)))
        passage = F.substring("text", place.cast("int") + 1, F.lit(s.chars_per_doc))
        picked = rows.where(drawn < share[F.col("lang")]).select("doc_id", "lang", passage.alias("passage"))
        bound = 2 * s.docs_per_lang * len(sizes) + 1000
        order = F.xxhash64("doc_id", "lang", F.lit(s.seed + 2))
        samples = [
            (-1 if r["doc_id"] is None else r["doc_id"], r["lang"], r["passage"].encode())
            for r in picked.orderBy(order, "doc_id", "lang", "passage").limit(bound).collect()
        ]
    return train(samples, s)


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Language of every whole text: the columns ``keep`` (all by default, but for those the
    result adds), ``lang_pred``, ``score`` and ``rejected``.

    A null text and a text without a letter get ``und``, score 0, and are rejected. Others get the
    likeliest language, its calibrated probability as score, and are rejected if that or the share of
    their subwords that training saw is below the model's thresholds. Only the text decides, so equal texts are treated alike.
    """
    added = ("lang_pred", "score", "rejected")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in added]
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = {f"c{i}": c for i, c in enumerate(keep)}
    letters = F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(
        *(column(c).alias(a) for a, c in names.items()),
        F.when(letters, F.col("text").cast("string").cast("binary")).alias("t"),
    )
    schema = rows.drop("t").schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = sent.value
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            best, sure, rejected = m.predict([t or b"" for t in texts])
            none = np.array([t is None for t in texts], bool)
            langs = [UNKNOWN if n else m.langs[b] for b, n in zip(best, none, strict=True)]
            score = np.where(none, 0.0, np.clip(sure, 0, 1))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(langs, pa.string()),
                    pa.array(score),
                    pa.array(none | rejected),
                ],
                [*names, *added],
            )

    out = rows.mapInArrow(run, schema)
    return out.select(*(F.col(a).alias(c) for a, c in names.items()), *added)
