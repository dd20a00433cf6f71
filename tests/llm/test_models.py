import random

import numpy as np

from tests.llm import data
from wattspark.llm import langid, toxicity

SMALL = langid.Settings(docs_per_lang=60, chars_per_doc=400, buckets=1 << 12)


def prose(rnd, letters, n):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(2, 8))) for _ in range(n))


def test_languages_are_told_on_held_out_texts(spark):
    rnd = random.Random(0)
    kinds = {"xx": "abcdefgh", "yy": "ghijklmn", "zz": "äöüabxyz"}
    rows = [(i, prose(rnd, kinds[k], rnd.randint(5, 80)), k) for i, k in enumerate(sorted(kinds) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs.where("doc_id % 4 != 2"), SMALL)
    got = langid.identify(docs, model).where("doc_id % 4 = 2").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    assert all(0 <= r.score <= 1 for r in got) and not any(r.rejected for r in got if r.score > 0.5)


def test_texts_without_letters_are_und_and_columns_stay(spark):
    texts = data.texts(1, 20)
    docs = data.frame(spark, texts)
    model = langid.fit(docs, SMALL)
    got = langid.identify(docs, model).collect()
    assert len(got) == len(texts) and [c for c in docs.columns if c not in got[0].asDict()] == []
    for r in got:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or (r.rejected and r.score == 0))
    assert langid.identify(docs.where("false"), model).count() == 0
    none = langid.fit(docs.where("false"), SMALL)
    assert all(r.rejected for r in langid.identify(docs, none).collect())


def test_parts_of_a_long_text_have_its_subwords():
    rnd = random.Random(5)
    texts = [b"word " * 1000, b"x" * 500, "äöü".encode() * 90, b"a\n" * 99, b" " * 200, b"ab cd" + b"e" * 64 + b" f"]
    texts += [bytes(rnd.choice(b"abc \n\t") for _ in range(rnd.randint(30, 400))) for _ in range(200)]
    texts += [bytes(rnd.choice(b"abcdefghijklmnopqrstuvwxyz ") for _ in range(rnd.randint(30, 400))) for _ in range(400)]
    sizes = (2, 3, 4)
    for text in texts:
        for size in (7, 16, 33):
            parts = list(langid._parts(text, 4, size))
            found = [langid.subwords(p, sizes, *ends) for p, *ends in parts]
            assert sorted(np.concatenate(found).tolist()) == sorted(langid.subwords(text, sizes).tolist()), (text, size)
            assert max(len(p) for p, *_ in parts) <= size + 3


def test_texts_of_no_learned_language_are_rejected(spark):
    rnd = random.Random(1)
    kinds = {"xx": "abcdefgh", "yy": "ghijklmn", "zz": "äöüabxyz"}
    rows = [(i, prose(rnd, kinds[k], rnd.randint(20, 80)), k) for i, k in enumerate(sorted(kinds) * 60)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), SMALL)
    other = [(i, prose(rnd, "опрстуфх", 60)) for i in range(40)]
    told = langid.identify(spark.createDataFrame(other, "doc_id long, text string"), model).collect()
    known = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()
    assert np.mean([r.rejected for r in told]) >= 0.9 and not any(r.rejected for r in known)


def test_repeated_ids_train_alike_in_any_order(spark):
    rnd = random.Random(6)
    rows = [(i % 3, prose(rnd, "abcdefgh" if i % 2 else "ghijklmn", 30), "xx" if i % 2 else "yy") for i in range(900)]
    few = langid.Settings(docs_per_lang=10, chars_per_doc=200, buckets=1 << 12)
    tables = []
    for parts in (1, 5):
        docs = spark.createDataFrame(rows[::-1] if parts > 1 else rows, "doc_id long, text string, lang string")
        tables.append(langid.fit(docs.repartition(parts), few).table)
    assert np.array_equal(*tables)


def tiny():
    return toxicity.Settings(words=64, word_dim=3, chars=32, char_dim=2, hidden=3, window=6, stride=3)


def test_gradients_are_right():
    s = tiny()
    p = {k: v.astype(np.float64) for k, v in toxicity.initial(s).items()}
    b = toxicity.layout([b"a bad word in a text of eleven words that goes on", b"short one"], s)
    y = np.array([1.0, 0.0])

    def loss():
        total, _ = toxicity.pool(toxicity._forward(p, b)[0], b.doc, b.docs, s.sharpness)
        return float(np.sum(np.logaddexp(0, total) - y * total))

    logits, kept = toxicity._forward(p, b, keep=True)
    total, share = toxicity.pool(logits, b.doc, b.docs, s.sharpness)
    d = (toxicity._sigmoid(total) - y)[b.doc] * share * (1 + s.sharpness * (logits - total[b.doc]))
    grads = toxicity._backward(p, b, kept, d)
    rnd = np.random.default_rng(1)
    for name, g in grads.items():
        for at in rnd.choice(np.flatnonzero(np.abs(g).ravel() >= np.abs(g).max() / 2), 3):
            flat, h = p[name].reshape(-1), 1e-2
            old = flat[at]
            flat[at] = old + h
            up = loss()
            flat[at] = old - h
            down = loss()
            flat[at] = old
            assert abs((up - down) / (2 * h) - g.ravel()[at]) < 2e-2 * max(1e-2, abs(g.ravel()[at])) + 2e-3, name


def test_toxic_words_are_learned_and_every_row_is_scored(spark):
    rnd = random.Random(4)
    rows = []
    known = prose(rnd, "abcdefghij", 150).split()
    for i in range(500):
        w = rnd.choices(known, k=rnd.randint(3, 70))
        if i % 3 == 0:
            w.insert(rnd.randrange(len(w)), rnd.choice(["vileword", "nastything"]))
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(500) if i % 5], "doc_id long, label int")
    model = toxicity.fit(docs, labels, toxicity.Settings(docs_per_label=300, epochs=16))
    got = toxicity.scores(docs, model).where("doc_id % 5 = 0").collect()
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 3 == 0) for r in got]) > 0.9
    odd = toxicity.scores(data.frame(spark, data.texts(2, 10)), model).collect()
    assert len(odd) == len(data.texts(2, 10)) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.scores(docs.where("false"), model).count() == 0


def test_every_word_is_in_a_window():
    s = tiny()
    for n in range(30):
        b = toxicity.layout([" ".join(f"w{i}" for i in range(n)).encode()], s)
        assert set(b.windows.ravel().tolist()) >= set(range(1, n + 1)) and len(b.windows) >= 1
