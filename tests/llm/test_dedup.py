import random

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from tests.llm import brute, data
from wattspark.llm import repeats, simhash, substring_dedup, suffix_dedup
from wattspark.llm.components import connected


@pytest.mark.parametrize("hot", [8192, 1])
def test_repeated_words_go(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_KEY", hot)
    texts = data.texts()
    got = {r.doc_id: tuple(r)[1:4] for r in substring_dedup.deduplicated(data.frame(spark, texts)).collect()}
    assert got == dict(enumerate(brute.words_kept(texts, 35)))


@pytest.mark.parametrize("hot", [8192, 1])
def test_later_bytes_go(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT_KEY", hot)
    texts = data.texts(4, 25)
    got = {r.doc_id: tuple(r)[1:5] for r in suffix_dedup.deduplicated(data.frame(spark, texts)).collect()}
    assert got == dict(enumerate(brute.bytes_kept(texts, 100)))


def test_rows_that_share_an_id_or_have_none_are_documents(spark):
    text = data.words(random.Random(1), 60)
    docs = data.frame(spark, [text, text, text, "short", None], [4, 4, None, None, 9])
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_removed) for r in substring_dedup.deduplicated(docs).collect())
    assert got == [(False, 4, 60, 60), (False, 4, 60, 60), (False, 9, 0, 0), (True, 0, 1, 0), (True, 0, 60, 60)]
    found = suffix_dedup.deduplicated(docs).where("n_bytes > 10").collect()
    assert sorted(r.n_removed == 0 for r in found) == [False, False, True]


def test_empty_tables_give_no_rows(spark):
    docs = data.frame(spark, ["a"]).where("doc_id < 0")
    assert substring_dedup.deduplicated(docs).count() == 0
    assert suffix_dedup.deduplicated(docs).count() == 0
    assert simhash.near_duplicates(docs).count() == 0


def test_segments_do_not_depend_on_how_texts_are_cut(monkeypatch):
    text = data.words(random.Random(2), 5000).encode()
    symbols = [substring_dedup._symbols(text)] * 2
    whole = repeats.segments(symbols, 35, 8)
    monkeypatch.setattr(repeats, "BLOCK", 1000)
    cut = repeats.segments(symbols, 35, 8)
    assert whole.windows.sum() == cut.windows.sum() == 2 * (5000 - 34)
    assert set(whole.key.tolist()) == set(cut.key.tolist())


def test_window_buckets_equal_windows():
    rnd = np.random.default_rng(0)
    text = rnd.integers(97, 99, 3000).astype(np.uint8)
    for length in (3, 8, 20, 37):
        asked = np.arange(len(text) - length + 1)
        got = suffix_dedup.window_buckets(text, asked, length)
        strings = [text[i : i + length].tobytes() for i in asked]
        assert len(set(zip(got.tolist(), strings))) == len(set(got.tolist())) == len(set(strings))


def test_matching_statistics_count_runs_that_occur_twice():
    a = substring_dedup.Automaton()
    first, second = "a b c d e".split(), "x b c d y b c".split()
    paths = [a.add(first, 1), a.add(second, 1)]
    often = np.array(a.finish())
    assert a.statistics(paths[0], often).tolist() == [0, 1, 2, 3, 0]
    assert a.statistics(paths[1], often).tolist() == [0, 1, 2, 3, 0, 1, 2]


def test_added_sequences_keep_the_states_of_their_prefixes():
    rnd = random.Random(5)
    sequences = [[rnd.choice("abc") for _ in range(rnd.randint(1, 30))] for _ in range(60)]
    a = substring_dedup.Automaton()
    paths = [a.add(s, 1) for s in sequences]
    assert [a.read(s) for s in sequences] == paths


def test_every_removed_word_and_byte_comes_from_the_methods(spark, monkeypatch):
    """Without what automata and buckets find, nothing is removed, copies included."""
    texts = data.texts()
    for module, length in ((substring_dedup, 35), (suffix_dedup, 100)):
        docs = data.frame(spark, texts)
        m = module.method(length)
        nothing = repeats.Method(m.length, m.gram, m.symbols, m.units, m.cut, lambda *a: [], m.keep_first)
        assert repeats.repeated(docs, nothing)[1].count() == 0
        assert repeats.repeated(docs, m)[1].count() > 0


def test_simhash_equals_brute_force(spark):
    texts = data.texts(6, 50)
    got = simhash.near_duplicates(data.frame(spark, texts)).orderBy("doc_id").collect()
    prints = [brute.fingerprint(t) for t in texts]
    assert [r.fp & (1 << 64) - 1 for r in got] == prints
    assert [r.component_id for r in got] == brute.components(prints, range(len(texts)))


@pytest.mark.parametrize("distance", [0, 2, 3])
def test_links_are_complete(spark, distance):
    rnd = random.Random(distance)
    prints = {rnd.getrandbits(64) for _ in range(60)}
    for p in sorted(prints):
        for _ in range(4):
            for bit in rnd.sample(range(64), rnd.randint(1, 5)):
                p ^= 1 << bit
            prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), distance).collect()
    pairs = [frozenset((r.u, r.v)) for r in found]
    want = {
        frozenset((a, b)) for a in signed for b in signed
        if a != b and bin((a ^ b) & (1 << 64) - 1).count("1") <= distance
    }
    assert set(pairs) == want and len(pairs) == len(want)


def test_components_of_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(40)]
    hub = [(100, 100 + i) for i in range(1, 60)]
    got = connected(spark.createDataFrame([*path, *hub, (7, 7)], "u long, v long")).collect()
    assert {r.node: r.root for r in got} == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100)}
    assert len(got) == 101
    assert connected(spark.range(0).select(F.col("id").alias("u"), F.col("id").alias("v"))).count() == 0


@pytest.mark.parametrize("m", [substring_dedup.method(), suffix_dedup.method()])
def test_texts_are_fetched_again_only_for_hot_keys(spark, monkeypatch, m):
    docs = data.frame(spark, data.texts(4, 25))
    read_texts = lambda: "packed" in repeats.repeated(docs, m)[1]._jdf.queryExecution().analyzed().toString()
    assert not read_texts()
    monkeypatch.setattr(repeats, "HOT_KEY", 1)
    assert read_texts()


def test_first_places_are_ordered_by_document_then_place():
    text = bytes(range(97, 123)) * 5
    places = [(2, 0, 0), (1, 0, 9), (1, 0, 3)]
    got = suffix_dedup.repeats_in([text[:110], text[:105], text[:100]], np.array([11, 6, 1]), np.ones(3, np.int64), places)
    assert sorted(got) == [(0, 0, 6, False), (1, 0, 1, False)]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_texts_keep_their_marks_however_rows_are_cut(size):
    given = [(b"one", [(0, 2), (5, 1)]), (b"", []), (b"two", []), (b"three", [(i, 1) for i in range(9)]), (b"four", [(3, 3)])]
    rows = []
    for doc, (text, marks) in enumerate(given):
        rows.append({"doc": doc if doc else repeats.NO_ID, "packed": zstandard.compress(text), "start": None, "windows": None})
        rows += [{"doc": doc, "packed": None, "start": a, "windows": n} for a, n in marks]
    kinds = pa.schema({"doc": pa.int64(), "packed": pa.binary(), "start": pa.int32(), "windows": pa.int32()})
    batches = [pa.RecordBatch.from_pylist(rows[i : i + size], kinds) for i in range(0, len(rows), size)]
    got = [(i, text, list(zip(a.tolist(), n.tolist()))) for ids, found in repeats.spanned(iter(batches)) for i, (text, a, n) in zip(ids.to_pylist(), found)]
    assert got == [(doc or None, text, marks) for doc, (text, marks) in enumerate(given)]


def test_texts_meet_their_spans_by_one_sort(spark):
    packed, spans = repeats.repeated(data.frame(spark, data.texts(4, 25)), suffix_dedup.method())
    plan = repeats.with_spans(packed, spans.localCheckpoint())._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan and "Sort [" in plan


@pytest.mark.parametrize("m", [substring_dedup.method(), suffix_dedup.method()])
def test_copies_are_dealt_alike_at_every_size(spark, m):
    """A table small enough to be sent to all is joined as a large one is."""
    plan = repeats.repeated(data.frame(spark, data.texts(4, 25)), m)[1]._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_only_texts_with_windows_of_hot_keys_are_dealt_again(spark, monkeypatch):
    rnd, passed, windows = random.Random(6), [], repeats._windows
    hot = data.words(rnd, 12)  # one anchor with many surroundings
    given = [data.words(rnd, 90) for _ in range(60)]
    given[:20] = [f"{data.words(rnd, 60)} {hot} {data.words(rnd, 60)}" for _ in range(20)]
    monkeypatch.setattr(repeats, "HOT_KEY", 5)
    monkeypatch.setattr(repeats, "_windows", lambda packed, *a: passed.append(packed) or windows(packed, *a))
    repeats.repeated(data.frame(spark, given), substring_dedup.method())
    found = {r.doc for r in passed[0].select("doc").collect()}
    assert len(found) > 5 and found <= set(range(20))
