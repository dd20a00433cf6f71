import hashlib
import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute, data
from tools.check_oracles import TABLES, rows_of
from wattspark.llm import decontaminate, mixing, quality, queries, sharding, simhash, token_rollup

FOLDER = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@given
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    df, want = queries.QUERIES[name](spark, FOLDER), con.sql(queries.ORACLES[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(want.columns, want.fetchall())


def test_leaks_equal_brute_force(spark):
    texts = data.texts(8, 30)
    items = [" ".join((t or "").split()[a : a + n]) for t, a, n in zip(texts, (0, 3, 9, 20, 1, 7), (14, 30, 50, 9, 4, 2))]
    items += [items[1] + " one two three four", items[1].upper() + "!", None, "", items[0]]
    tests = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontaminate.leaks(data.frame(spark, texts), tests, filter_bits=1 << 15).collect()
    want = {}
    for i, item in enumerate(items):
        wanted = brute.shingles(item)
        for d, text in enumerate(texts):
            shared = len(wanted & brute.shingles(text))
            if wanted and shared >= 0.8 * len(wanted) - 1e-9:
                want[d, i] = (len(wanted), shared)
    assert {(r.doc_id, r.item_id): (r.n_shingles, r.n_shared) for r in got} == want and len(got) == len(want) > 6
    assert decontaminate.leaks(data.frame(spark, texts), tests.where("false")).count() == 0
    assert decontaminate.leaks(data.frame(spark, texts).where("false"), tests).count() == 0


def test_mix_reads_sources_as_planned(spark):
    docs = data.frame(spark, [*data.texts(9, 60), "again twice", "again twice"], [*range(len(data.texts(9, 60))), 2, None])
    out = mixing.mix(docs, max_repeats=3.0)
    plan = {r.source: r for r in mixing.plan(docs, max_repeats=3.0).collect()}
    rows = out.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()}
    used = Counter()
    for r in rows:
        used[r.source] += r.n_tokens
        assert r.mix_epoch <= 3 and r.shard == 7
    for source, p in plan.items():
        assert used[source] <= p.target_tokens
    assert abs(sum(p.weight for p in plan.values()) - 1) < 1e-9 and None in plan
    assert mixing.mix(docs.where("false"), entropy_share=0.9, budget_tokens=10).count() == 0


def test_bisection_meets_the_entropy(spark):
    totals = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 10), ("d", 0)], "source string, tokens long")
    rows = mixing.weights(totals, 0.8, None, 500).collect()
    w = np.array([r.weight for r in rows])
    assert abs(-(w * np.log(w)).sum() - 0.8 * np.log(3)) < 1e-9 and len(rows) == 3


def test_a_budget_beyond_the_repeats_raises(spark):
    docs = data.frame(spark, ["one two three", "four five", "six"])
    with pytest.raises(Exception, match="more than 2.0 times"):
        mixing.mix(docs, max_repeats=2.0, budget_tokens=100).count()
    assert mixing.mix(docs, max_repeats=2.0, budget_tokens=12).count() == 6
    assert mixing.mix(docs.where("false"), max_repeats=2.0, budget_tokens=100).count() == 0


@pytest.mark.parametrize("per_span", [1, 2, 4096])
def test_spans_and_blocks_find_the_last_place(spark, monkeypatch, per_span):
    monkeypatch.setattr(mixing, "DOCS_PER_BLOCK", 3)
    monkeypatch.setattr(mixing, "BLOCKS_PER_SPAN", per_span)
    rnd = np.random.default_rng(2)
    rows = [(i, "w " * int(rnd.integers(0, 9)), ["a", "b", None][min(2, i // 60)]) for i in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {(r.doc_id, r.mix_epoch) for r in mixing.mix(docs, entropy_share=0.99, budget_tokens=900, seed=4).collect()}
    plan = {r.source: r for r in mixing.plan(docs, entropy_share=0.99, budget_tokens=900, seed=4).collect()}
    want = set()
    for source, p in plan.items():
        mine = [(i, t.split()) for i, t, s in rows if s == source]
        want |= {(i, e) for i, _ in mine for e in range(p.full_epochs)}
        place = lambda i: hashlib.md5(f"4:{p.full_epochs}:{i}".encode()).hexdigest()[:15]
        read = p.full_epochs * p.tokens
        for i, words in sorted(mine, key=lambda x: place(x[0])):
            read += len(words)
            if read > p.target_tokens:
                break
            want.add((i, p.full_epochs))
    assert got == want


def test_no_source_falls_short_at_any_size(spark):
    for i in range(6):
        given = [("a", 7 * 10**14 + 31 * i), ("b", 3 * 10**14 + i), ("c", 10**13 + 7 * i), ("d", 977 + i)]
        totals = spark.createDataFrame(given, "source string, tokens long")
        rows = mixing.weights(totals, None, 2.0, None).collect()
        assert len(rows) == 4 and all(r.target_tokens >= r.tokens for r in rows)


def test_shards_are_exact_and_shuffled(spark):
    docs = data.frame(spark, data.texts(10, 90))
    n = docs.count()
    rows = sharding.shuffle_to_shards(docs, 7, seed=1).collect()
    sizes = Counter(r.shard for r in rows)
    assert sum(sizes.values()) == n and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(7):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    assert sorted((r.doc_id, r.text or "") for r in rows) == sorted((r.doc_id, r.text or "") for r in docs.collect())
    assert sharding.shuffle_to_shards(docs.where("false"), 7).count() == 0


def test_matrix_sums_and_permutations():
    rows, sizes = np.array([5, 0, 17, 40]), sharding.shard_sizes(62, 9, 3)
    m = sharding.communication_matrix(rows, sizes, 5)
    assert (m.sum(axis=1) == rows).all() and (m.sum(axis=0) == sizes).all() and (m >= 0).all()
    for n in (1, 2, 3, 64, 1000):
        assert sorted(sharding.permuted(np.arange(n), n, 11).tolist()) == list(range(n))
    for parts in (1, 2, 3, 10, 37):
        rows = np.random.default_rng(parts).integers(0, 50, parts)
        sizes = sharding.shard_sizes(int(rows.sum()), 5, 3)
        totals, width = sharding.block_totals(rows, sizes, 5), sharding.block_width(parts)
        m = np.concatenate([sharding.block_matrix(rows, totals, b, 5) for b in range(len(totals))])
        assert (m.sum(axis=1) == rows).all() and (m.sum(axis=0) == sizes).all() and (m >= 0).all()
        assert len(totals) <= width and width <= parts**0.5 + 1
    rows, sizes, draws = np.array([6, 10, 4, 8]), np.array([14, 14]), []
    for seed in range(3000):
        totals = sharding.block_totals(rows, sizes, seed)
        draws.append(sharding.block_matrix(rows, totals, 1, seed)[1, 0])  # 8 of 28 rows, to one of two halves
    assert abs(np.mean(draws) - 4) < 0.1 and abs(np.var(draws) - 8 * 0.25 * 20 / 27) < 0.1
    rng = np.random.default_rng(0)
    big = [sharding.hypergeometric(10**9, 3 * 10**9, 1000, rng) for _ in range(400)]
    assert abs(np.mean(big) - 250) < 4 and abs(np.std(big) - 13.7) < 2


def test_quality_of_odd_texts(spark):
    texts = ["", None, "Home | About us | Contact us\n" + "This is a full sentence of clean words here. " * 1, "x y " * 30]
    texts += ["All rights reserved by someone\nA line that reads like any other line of prose, and ends.\n\n"]
    got = {r.doc_id: r for r in quality.clean(data.frame(spark, texts)).collect()}
    assert not got[0].kept and not got[1].kept and got[0].n_words == got[1].n_words == 0
    assert got[2].n_bad_lines == 1 and "Home" not in got[2].clean_text
    assert got[3].base_failed and got[3].n_repeat_words == 60
    assert got[4].kept and got[4].n_bad_lines == 1 and got[4].clean_text.startswith("A line")
    assert quality.clean(data.frame(spark, texts).where("false")).count() == 0


def test_rollup_is_additive_and_batches_are_idempotent(spark, tmp_path):
    docs = data.frame(spark, data.texts(11, 20))
    counted = token_rollup.counts(docs, {"w": token_rollup.words, "l": token_rollup.letter_words})
    rollup = token_rollup.Rollup(spark, str(tmp_path / "r"))
    assert rollup.totals().count() == 0
    assert rollup.commit("a", token_rollup.inserted(counted, "v", "w"))
    first = sorted(map(tuple, rollup.totals().collect()), key=str)
    assert not rollup.commit("a", token_rollup.inserted(counted, "v", "w"))
    assert sorted(map(tuple, rollup.totals().collect()), key=str) == first
    assert sum(r[4] for r in first) == sum(len((t or "").encode().split()) for t in data.texts(11, 20))
    rollup.commit("b", token_rollup.revised(counted, "v", "w", "l"))
    assert rollup.totals().agg({"docs": "sum"}).first()[0] == docs.count()
    rollup.commit("c", token_rollup.deleted(counted, "v", "l"))
    assert rollup.totals().count() == 0
    with pytest.raises(ValueError):
        rollup.commit("../x", token_rollup.inserted(counted, "v", "w"))


def test_a_batch_counts_by_its_own_commit(spark, tmp_path):
    rollup = token_rollup.Rollup(spark, str(tmp_path / "r"))
    counted = token_rollup.counts(data.frame(spark, ["a b", "c"]), {"w": token_rollup.words})
    rollup.commit("a", token_rollup.inserted(counted, "v", "w"))
    for part in (tmp_path / "r" / "deltas").rglob("_SUCCESS"):  # a cluster may be set to write none
        part.unlink()
    assert not rollup.commit("a", token_rollup.inserted(counted, "v", "w"))
    with pytest.raises(ValueError, match="other changes"):
        rollup.commit("a", token_rollup.deleted(counted, "v", "w"))
    assert rollup.totals().agg({"tokens": "sum"}).first()[0] == 3
    # a commit that was cut short: the delta is there, its note is missing or empty
    os.remove(tmp_path / "r" / "commits" / "a")
    assert rollup.totals().count() == 0 and not rollup.committed("a")
    (tmp_path / "r" / "commits" / "a").write_text("")
    assert rollup.totals().count() == 0
    assert rollup.commit("a", token_rollup.inserted(counted, "v", "w"))
    assert rollup.totals().agg({"tokens": "sum"}).first()[0] == 3


def test_folded_batches_stay_committed(spark, tmp_path):
    rollup = token_rollup.Rollup(spark, str(tmp_path / "r"))
    counted = token_rollup.counts(data.frame(spark, data.texts(13, 9)), {"w": token_rollup.words})
    rollup.compact()
    rollup.commit("a", token_rollup.inserted(counted, "v", "w"))
    rollup.commit("b", token_rollup.inserted(counted, "u", "w"))
    before = sorted(map(tuple, rollup.totals().collect()), key=str)
    rollup.compact()
    assert sorted(map(tuple, rollup.totals().collect()), key=str) == before
    assert not rollup.commit("a", token_rollup.inserted(counted, "v", "w"))
    rollup.commit("c", token_rollup.deleted(counted, "u", "w"))
    rollup.compact()
    assert sorted(map(tuple, rollup.totals().collect()), key=str) == [r for r in before if r[2] == "v"]


def test_token_counts_query_equals_brute_force(spark, tmp_path):
    """Repeated rows, repeated ids, no ids, empty documents, nulls in every column."""
    texts = [*data.texts(14, 20), "same text !", "same text !", "same text !", "same text !", None, "", "again", "again"]
    n = len(data.texts(14, 20))
    ids = [*range(n), 5, 5, None, None, None, 9000, 3, 3]
    docs = data.frame(spark, texts, ids).withColumn("text_hash", F.lit("clash")).withColumn("words", F.lit(1))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.token_counts(spark, str(tmp_path))
    bpe = token_rollup.Bpe.from_file(queries.VOCABULARY)
    best = {}
    for r in docs.collect():
        none = lambda x: (x is not None, x or "")
        key = (r.doc_id is None, r.doc_id or 0, none(r.source), none(r.lang))
        best[r.text or ""] = min(best.get(r.text or "", (key, r)), (key, r), key=lambda x: x[0])
    want = {}
    for text, (_, r) in best.items():
        letters = [w for w in text.encode().split() if any(c >= 128 or chr(c).isalnum() for c in w)]
        for version, tokens in (("byte_bpe_50k", bpe([text])[0]), ("words", len(letters))):
            docs_, tokens_ = want.get((r.source, r.lang, version), (0, 0))
            want[r.source, r.lang, version] = (docs_ + 1, tokens_ + tokens)
    assert {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in got.collect()} == want
    empty = tmp_path / "empty"
    docs.where("false").write.parquet(f"{empty}/documents.parquet")
    assert queries.token_counts(spark, str(empty)).count() == 0
    with pytest.raises(FileNotFoundError, match="vocabulary"):
        queries.token_counts(spark, str(tmp_path), "/nowhere")


@pytest.mark.skipif(not os.path.exists(queries.VOCABULARY), reason="no vocabulary")
def test_bpe_counts_go_back_to_the_text():
    bpe = token_rollup.Bpe.from_file(queries.VOCABULARY)
    texts = ["", "Hello there, it's 2024!", "ñandú  über\n\nça"]
    found = bpe(texts)
    assert found == [len(bpe._encoding.encode_ordinary(t)) for t in texts]
    assert [bpe._encoding.decode(bpe._encoding.encode_ordinary(t)) for t in texts] == texts


@given
def test_pipeline_stages(spark):
    docs = queries.table(spark, FOLDER, "documents")
    columns = docs.columns
    told = corpus_pipeline.language(spark, docs, FOLDER)
    single = corpus_pipeline.near_duplicates(spark, told, FOLDER)
    assert told.columns == single.columns == columns
    groups = {r.component_id for r in simhash.near_duplicates(told).collect()}
    assert {r.doc_id for r in single.collect()} == groups
    clean = corpus_pipeline.decontaminated(spark, single, FOLDER)
    bench = [brute.shingles(r.text) for r in queries.table(spark, FOLDER, "benchmark").collect()]
    for r in single.join(clean.select("doc_id"), "doc_id", "left_anti").collect():
        assert any(len(b & brute.shingles(r.text)) >= 0.8 * len(b) - 1e-9 for b in bench)
    final = corpus_pipeline.run(spark, FOLDER).collect()
    kept = {r.doc_id for r in clean.collect()}
    assert {r.doc_id for r in final} == kept and Counter(r.doc_id for r in final).most_common(1)[0][1] <= 3


def test_stages_take_odd_tables(spark, tmp_path):
    docs = data.frame(spark, [*data.texts(12, 12), None], [*range(len(data.texts(12, 12))), None])
    # the group of empty texts has rows with ids, one of which stands for it
    assert corpus_pipeline.near_duplicates(spark, docs, "").where("doc_id IS NULL").count() == 0
    assert corpus_pipeline.language(spark, docs, "").columns == docs.columns
    assert corpus_pipeline.mixed(spark, docs, "").columns == docs.columns
    assert corpus_pipeline.sharded(spark, docs, "").count() == docs.count()
    clean = docs.where("doc_id = 0 OR doc_id IS NULL")
    clean.limit(0).selectExpr("doc_id AS item_id", "text").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.decontaminated(spark, clean, str(tmp_path)).columns == docs.columns


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    alone, first, second = "one of its own kind " * 9, "the first text said again " * 9, "a second text unlike it " * 9
    given = [(1, first), (1, first), (2, second), (2, first), (3, second), (None, second), (None, second), (None, alone)]
    given += [(7, alone)]
    docs = data.frame(spark, [t for _, t in given], [i for i, _ in given])
    got = corpus_pipeline.near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert Counter(r.text for r in got.collect()) == {first: 1, second: 1, alone: 1}
    assert {r.text: r.doc_id for r in got.collect()} == {first: 1, second: 2, alone: 7}
    assert corpus_pipeline.near_duplicates(spark, docs.where("doc_id IS NULL"), "").count() == 2


def test_every_row_is_searched_for_every_item(spark, tmp_path):
    word = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    given = [(None, "so " + word(0, 30)), (None, "clean of it"), (4, "and " + word(40, 60)), (4, "clean too")]
    # two rows of one id hold half an item each
    given += [(5, word(80, 94)), (5, word(90, 104)), (6, word(120, 140) + " end"), (7, word(160, 180))]
    items = [(1, word(0, 30)), (2, word(40, 60)), (3, word(80, 104)), (None, word(120, 140)), (None, word(200, 220))]
    items += [(8, word(160, 180)), (8, word(300, 400))]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = data.frame(spark, [t for _, t in given], [i for i, _ in given])
    clean = corpus_pipeline.decontaminated(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert sorted(r.text for r in clean.collect()) == sorted(given[i][1] for i in (1, 3, 4, 5))


def test_mixing_keeps_columns_of_its_own_names(spark):
    docs = data.frame(spark, ["one two three", "four five", "six"]).selectExpr(
        "*", "concat('n', doc_id) AS n_tokens", "doc_id * 10 AS mix_place"
    )
    out = corpus_pipeline.mixed(spark, docs, "")
    assert out.dtypes == docs.dtypes
    assert {(r.doc_id, r.n_tokens, r.mix_place, r.mix_epoch) for r in out.collect()} == {(i, f"n{i}", 10 * i, "w") for i in range(3)}


def test_cleaned_text_keeps_order_and_repeats(spark):
    text = "Kept prose ends here.\n\nHome | News | About\nKept prose ends here.\nHome | News | About\n  "
    row = quality.clean(data.frame(spark, [text])).first()
    assert row.clean_text == "Kept prose ends here.\n\nKept prose ends here.\n  "
    assert (row.n_lines, row.n_bad_lines, row.n_dup_lines) == (4, 2, 2)
