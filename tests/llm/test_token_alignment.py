"""Token alignment against plain pairs of overlapping tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.data import frame, texts
from wattspark.llm import queries, token_alignment as ta

FOLDER = queries.TOKENIZERS
NAMES = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(f"{FOLDER}/byte_bpe_50k.json")
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/piece_bpe_32k.model")
    letters, entries = ta._letters(), {i: t for t, i in a.get_vocab().items()}

    def first(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(letters[c] for c in entries[i])) for i in ids]

    def second(text):
        pieces = [(i, b.id_to_piece(i)) for i in b.encode(text)]
        return [(i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()) for i, p in pieces]

    return first, second


def expected(rows, encoders):
    """Contract, spelled out: every pair of tokens is compared by its byte ranges."""
    found, count = [], Counter()
    for doc_id, text in rows:
        a, b = ([f(text) for f in encoders] if text else ([], []))
        raw = b"" if not text else (" " + text).encode()
        if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw or not text:
            found.append((doc_id, [], [], [], None))
            continue
        spans = []
        for tokens in (a, b):
            at, side = 0, []
            for i, t in tokens:
                side.append((i, at, at + len(t)))
                at += len(t)
            spans.append(side)
        links, j = [], 0
        for i, s, e in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        count.update(set(links))
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups, start = [], 0
        for end in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start <= s < end) for side in spans))
            start = end
        found.append((doc_id, a, b, links, ";".join(groups)))
    most = defaultdict(int)
    for (i, _), n in count.items():
        most[i] = max(most[i], n)
    return sorted(
        (
            (
                doc_id, len(a), len(b), 0 if text is None else text.count(";") + 1, len(links),
                sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links),
                "" if text is None else hashlib.sha256(text.encode()).hexdigest(),
            )
            for doc_id, a, b, links, text in found
        ),
        key=str,
    )


def odd_texts():
    return [
        "a  b", " lead", "trail ", "  ", " ", "tab\t x \n\n y", "a\n \n b", "<|endoftext|> <s> </s> <unk> <0x41>", "under▁score", "nul\x00 x",
        "é   x  y", "中文 句子没有空白。" * 5, "🙂 🙂🙂", "x" * 3000, "don't we'll I'M", "1234567 89 0", "\x85 \x1c z", "ﬁ Ａ ½", "﻿bom",
    ] + texts(seed=9, n=12)


def test_query(spark, tmp_path, encoders):
    given = [t if t is None or len(t) < 50_000 else t[:9_000] for t in odd_texts()]
    ids = [None if i == 3 else 7 if i in (7, 8) else i for i in range(len(given))]
    frame(spark, given, ids).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op13_token_alignment"](spark, str(tmp_path)).collect()
    assert sorted((tuple(r[n] for n in NAMES) for r in got), key=str) == expected(zip(ids, given), encoders)


def test_many_chunks_and_merges_of_merges(spark, monkeypatch, encoders):
    """One document a chunk and two runs a merge: the counts need several levels."""
    monkeypatch.setattr(ta, "FAN_IN", 2)
    given = odd_texts()[:19]
    docs = frame(spark, given).repartition(len(given))
    got = ta.aligned(docs, ta.Tokenizers.from_folder(FOLDER)).collect()
    assert sorted((tuple(r[n] for n in NAMES) for r in got), key=str) == expected(enumerate(given), encoders)


def test_empty_table(spark):
    docs = frame(spark, ["a"]).where("doc_id < 0")
    assert ta.aligned(docs, ta.Tokenizers.from_folder(FOLDER)).count() == 0


def test_units_are_encoded_as_in_their_text(encoders):
    rnd, made = random.Random(1), ta.Tokenizers.from_folder(FOLDER)
    encode, encode_all, *_ = made.loaded()
    alphabet = [" ", " ", "\n", "\t", " ", "a", "the", "'s", "é", "1", "!", "中", "́", "\x85", " "]
    for _ in range(2000):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 12)))
        units = [" " + u for u in ta.cut(pa.array([text]))[1].to_pylist()]
        assert "".join(units) == " " + text
        assert [i for u in units for i in encode(u)] == [i for i, _ in encoders[0](text)], repr(text)
        assert [i for u in encode_all([u[1:] for u in units]) for i in u] == [i for i, _ in encoders[1](text)], repr(text)


def test_merge_reads_runs_by_blocks(monkeypatch):
    monkeypatch.setattr(ta, "BLOCK", 8)
    rnd, total, runs = random.Random(2), Counter(), []
    for _ in range(7):
        run = {rnd.randrange(400): rnd.randint(1, 9) for _ in range(rnd.randint(1, 90))}
        total.update(run)
        keys = np.array(sorted(run), np.int64)
        runs.append((ta._packed(keys), ta._packed(np.array([run[k] for k in keys.tolist()], np.int64))))
    keys, held = ta.merged(runs)
    assert dict(zip(keys.tolist(), held.tolist())) == total and keys.tolist() == sorted(total)


def test_a_missing_vocabulary_is_named(tmp_path):
    with pytest.raises(FileNotFoundError, match="name the folder"):
        ta.Tokenizers.from_folder(str(tmp_path))
