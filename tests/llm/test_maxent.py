"""The language model: counts against plain ones, probabilities that add up to one, gradients, gain on held-out text."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.data import frame, texts
from wattspark.llm import maxent, queries

SMALL = maxent.Settings(frequent=40, classes=4, width=5, neighbours=8, bits=6, rounds=2, tokens_per_task=2000, batch=64)


def tokens(text):
    small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w.decode() for w in small.encode().split()] + [None]


def base(rows):
    """Contract, spelled out: held out, tokens, known ones, training tokens and the base score of each row."""
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    count = Counter(w for (_, t), h in zip(rows, held) if not h for w in tokens(t))
    n, v = sum(count.values()), len(count)
    out = []
    for (i, t), h in zip(rows, held):
        score = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in tokens(t))
        out.append((i, h, len(tokens(t)), sum(count[w] > 0 for w in tokens(t)), n, round(score, 6)))
    return sorted(out, key=str)


def shown(df):
    return sorted(
        ((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str
    )


def test_query_counts(spark, tmp_path):
    given = [t if t is None or i % 3 else t.upper() for i, t in enumerate(texts(seed=4))]
    given += ["unheard " * 700, "É a\x1cb c d\x0be\x85f"]
    ids = [None if i in (5, 6) else 9 if i in (9, 10) else i for i in range(len(given))]
    frame(spark, given, ids).write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.QUERIES["op11_lm_scoring"](spark, str(tmp_path))
    assert shown(found) == base(list(zip(ids, given)))
    assert found.where("score IS NULL OR isnan(score) OR score >= 0").count() == 0


def test_rare_words_are_joined(spark):
    """With few frequent words most counts come from the join; the sums stay the same."""
    given = texts(seed=6)
    docs = frame(spark, given)
    found = maxent.scored(docs, queries.remainder(7) == 2, SMALL)
    assert shown(found) == base(list(enumerate(given)))


@pytest.mark.parametrize("held_out", [True, False])
def test_nothing_to_learn_from(spark, held_out):
    docs = frame(spark, ["a b", None, ""] if held_out else [])
    found = maxent.scored(docs, F.lit(held_out), SMALL).collect()
    assert len(found) == (3 if held_out else 0)
    assert all(r.n_known == 0 and r.train_tokens == 0 and r.base_score == 0 for r in found)


def trained(spark):
    rnd = random.Random(8)
    pools = [["red", "green", "blue", "of", "the"], ["rot", "gelb", "blau", "und", "der"]]
    given = [" ".join(rnd.choice(pools[i % 2]) for _ in range(30)) + f" rare{i}" for i in range(120)]
    docs = frame(spark, given)
    words = maxent.frequent(maxent.counted(docs), SMALL.frequent)
    table = maxent.numbered(docs.withColumn("held_out", F.lit(False)), words, SMALL.classes * SMALL.width)
    train = table.where("word IS NULL").withColumn("round", F.col("doc") % 2).select("ids", "round")
    return words, maxent.fit(train, words, SMALL)


def test_probabilities_add_up_to_one(spark):
    words, model = trained(spark)
    inside = model.inside
    for history in ([], [3], [7, 2], [1, 500, 4]):
        ids = [np.array([*history, w], np.int64) for w in range(inside + 1)]  # the last has no class
        starts = np.arange(len(ids)) * (len(history) + 1)
        logs = model.log_probabilities(np.concatenate(ids), starts)[len(history) :: len(history) + 1]
        assert math.isclose(np.exp(logs).sum(), 1, rel_tol=1e-4)
    # words without a class share what that class has, one share being left for words never seen
    outside = sum(int(n) + 1 for n in words.counts[inside:]) + 1
    rest = words.tokens - int(words.counts.sum()) + words.distinct - len(words.words)
    assert model.outside == outside + rest


def test_training_lowers_the_loss(spark):
    words, model = trained(spark)
    fresh = maxent.Model(SMALL, [np.flatnonzero(model.of == i) for i in range(4)], words.counts[: model.inside], model.outside)
    number = {w: i for i, w in enumerate(words.words.to_pylist())}
    ids = np.array([number[w] for w in "red of the blue green red rot gelb und der blau".split()], np.int64)
    at = np.array([0, 6])
    assert model.log_probabilities(ids, at).sum() > fresh.log_probabilities(ids, at).sum() + 2


def test_steps_follow_the_gradient():
    """The change of a row's weights points along the numeric gradient of the log likelihood."""
    s = maxent.Settings(classes=2, width=3, bits=10, batch=1000, rate=1e-6)
    model = maxent.Model(s, [np.array([0, 1, 2]), np.array([3, 4])], np.array([9, 7, 5, 3, 1]), 2.0)
    rnd = np.random.default_rng(3)
    ids, starts = rnd.integers(0, 6, 40), np.array([0, 13, 30])
    rows = np.unique(np.concatenate(model.contexts(ids, starts)[0]))
    places = (rows[:, None] * 3 + np.arange(3)).ravel()
    moved = model.copy()
    moved.train(ids, starts)
    change = (moved.theta - model.theta).astype(np.float64)[places].reshape(-1, 3)
    numeric = []
    for i in places:
        up, down = model.copy(), model.copy()
        up.theta[i] += 1e-2
        down.theta[i] -= 1e-2
        numeric.append(up.log_probabilities(ids, starts).sum() - down.log_probabilities(ids, starts).sum())
    numeric = np.array(numeric).reshape(-1, 3)
    along = np.sum(change * numeric, axis=1) / np.linalg.norm(change, axis=1) / np.linalg.norm(numeric, axis=1)
    assert len(rows) > 30 and np.mean(along > 0.99) > 0.9  # two contexts may share a row


def test_words_before_stop_at_the_text():
    ids, starts = np.array([1, 2, 3, 4, 5, 6]), np.array([0, 1, 3])
    assert maxent.before(ids, starts, 2).tolist() == [-1, -1, -1, -1, -1, 4]
    assert maxent.before(ids, starts, 1).tolist() == [-1, -1, 2, -1, 4, 5]


def test_words_are_split_like_bytes():
    given = ["", " \t", "A b\x0bC\x0cd\re\nf", "É\x85x\x1cy z", None]
    words, n = maxent.split(pa.array(given))
    expected = [tokens(t)[:-1] for t in given]
    assert words.to_pylist() == [w for e in expected for w in e] and n.tolist() == list(map(len, expected))


def test_chunks_are_numbered_in_parts_of_bounded_size(monkeypatch):
    """Memory follows the part and not the chunk, and the rows are those of the whole chunk."""
    rnd, sizes, split = random.Random(2), [], maxent.split
    given = [" ".join(f"w{rnd.randrange(300)}" for _ in range(40)) for _ in range(1000)]
    n = len(given)
    rows = pa.record_batch({"doc_id": pa.array(range(n)), "held_out": pa.array([False] * n), "text": pa.array(given)})
    places, logs = maxent.Places(pa.array([maxent.END, *(f"w{i}" for i in range(200))])), np.log10(np.arange(201) + 2.0)
    monkeypatch.setattr(maxent, "split", lambda texts: sizes.append(len(texts)) or split(texts))

    def found():
        sizes.clear()
        table = pa.Table.from_batches(list(maxent._chunk(rows, places, logs, 50, 7))).to_pylist()
        texts = [{c: v for c, v in r.items() if c not in ("word", "docs", "times")} for r in table if r["word"] is None]
        held = {r["word"]: list(zip(r["docs"], r["times"])) for r in table if r["word"]}
        assert len(texts) + len(held) == len(table)  # a word has one row
        return max(sizes), texts, held, {r["chunk"] for r in table}

    whole = found()
    monkeypatch.setattr(maxent, "PART", 2000)
    parts = found()
    assert whole[0] == n and parts[0] == 50 and parts[1:] == whole[1:]
    assert len(whole[1]) == n and sum(t for x in whole[2].values() for _, t in x) == sum(int(w[1:]) >= 200 for t in given for w in t.split())


@pytest.mark.parametrize("alike", [False, True])
def test_places_are_those_of_the_words(monkeypatch, alike):
    """Also of words that share a hash with another one."""
    if alike:
        monkeypatch.setattr(maxent, "hashes", lambda words, n: np.array([len(w) for w in words], np.uint64))
    known = [maxent.END, "b", "aa", "a", "ab", "\u00e9"]
    asked = ["a", "zz", "\u00e9", "aa", "ab", "c", "b", "longer"]
    got = maxent.Places(pa.array(known)).of(pa.array(asked), asked)
    assert got.tolist() == [known.index(w) if w in known else -1 for w in asked]


def test_held_out_text_is_likelier_than_by_its_counts(spark):
    docs = queries.table(spark, "/root/testdata/sf0.01", "documents")
    found = maxent.scored(docs, queries.remainder(7) == 2).where("held_out")
    gain = found.agg((F.sum("score") - F.sum("base_score")) / F.sum("n_tokens")).first()[0]
    assert gain > 0.05
