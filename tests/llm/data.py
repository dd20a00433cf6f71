"""Small documents with everything that may go wrong."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, shard int, fp string, key string, "
    "spans string, score double, mix_epoch string, _id string, _mix string, `a.b` string"
)


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdeöz") for _ in range(rnd.randint(1, 7))) for _ in range(n))


def texts(seed=3, n=40):
    """Prose, exact and near copies, shared passages, periodic and very long texts, nulls and blanks."""
    rnd = random.Random(seed)
    out = [words(rnd, rnd.randint(1, 160)) for _ in range(n)]
    passage = words(rnd, 70)
    for i in range(0, n, 5):
        out[i] += " " + passage + " " + words(rnd, 5)
    for i in range(1, n, 7):
        near = out[i].split()
        near[len(near) // 2] = "changed"
        out.append(" ".join(near))
        out.append(out[i])
    out += [None, "", "   \n\t ", "na " * 300, "ab" * 400, passage, "ö" * 250, words(rnd, 30_000), "!!! ... ###"]
    return out


def frame(spark, given, ids=None):
    ids = range(len(given)) if ids is None else ids
    extra = (7, "x", "y", "z", 0.5, "w", "i", "m", "d")
    rows = [(i, t, "en" if i is None or i % 3 else "de", f"s{(i or 0) % 4}" if i != 5 else None, None, *extra) for i, t in zip(ids, given)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)
