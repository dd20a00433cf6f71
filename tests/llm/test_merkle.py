"""The Merkle manifest against plain recomputation."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest

from tests.llm.data import frame, texts
from wattspark.llm import merkle, queries

VALUES = ("doc_id", "source", "lang", "n_chars", "text")


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes):
    """The last node of a tree, and for every leaf its siblings, level by level, with its place in the run."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(last[i : i + 16]) for i in range(0, len(last), 16)])
    paths = []
    for at in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            first = at // 16 * 16
            path.append((level[first:at], level[at + 1 : first + 16]))
            at //= 16
        paths.append(path)
    return levels[-1][0], paths


def proofs(rows):
    """``(doc_id, leaf, subroot, root, proof, folded, verified)`` of every row."""
    by = defaultdict(list)
    if not rows:
        return []
    for r in rows:
        by[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, H(map(value, (r[v] for v in VALUES))), r))
    sources = sorted(by, key=lambda s: b"" if s is None else b"\1" + s.encode())
    held = [sorted(by[s], key=lambda x: x[:3]) for s in sources]
    trees = [tree([x[2] for x in h]) for h in held]
    root, tops = tree([t[0] for t in trees])
    out = []
    for (subroot, paths), above, leaves in zip(trees, tops, held):
        for (_, _, leaf, r), path in zip(leaves, paths):
            path, node = path + above, leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                small = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
                node = H(map(value, (small if v == "text" else r[v] for v in VALUES)))
            for left, right in path:
                node = H([*left, node, *right])
            out.append((r["doc_id"], leaf, subroot, root, H(x for a, b in path for x in a + b), node, node == root))
    return sorted(out, key=str)


def shown(df):
    names = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


@pytest.fixture
def asked(spark, tmp_path):
    def run(rows):
        rows.write.parquet(str(tmp_path / "documents.parquet"))
        found = queries.QUERIES["op12_merkle_manifest"](spark, str(tmp_path))
        return shown(found), proofs([r.asDict() for r in spark.read.parquet(str(tmp_path / "documents.parquet")).collect()])

    return run


def test_query_on_odd_rows(spark, asked):
    given = [t if t is None or i % 2 else t.replace("a", "A") for i, t in enumerate(texts(seed=5, n=20))]
    ids = [None if i in (3, 4) else i // 2 if i > 40 else i for i in range(len(given))]
    found, expected = asked(frame(spark, given, ids))
    assert found == expected


def test_query_on_a_large_source(spark, asked):
    """Three levels of blocks in one source, last runs of one node, many sources of one row."""
    n = 16**4 + 17
    rows = spark.range(n + 300).selectExpr(
        "id AS doc_id", f"CASE WHEN id >= {n} THEN concat('s', id) WHEN id % 9999 = 8 THEN '' ELSE 'hot' END AS source",
        "'en' AS lang", "id AS n_chars", "concat('Text ', id) AS text",
    )
    found, expected = asked(rows)
    assert len(found) == n + 300
    assert found == expected
    assert {v[6] for v in found} == {True, False}


def test_empty_table(spark, asked):
    found, expected = asked(frame(spark, []))
    assert found == expected == []


def test_equal_rows_each_have_a_proof(spark):
    docs = spark.createDataFrame([(1, "s", "x")] * 40, "doc_id long, source string, text string")
    found = merkle.manifest(docs, ("doc_id", "source", "text")).proofs().collect()
    assert len(found) == 40 and {len("".join(r.lefts + r.rights)) for r in found} == {64 * 17, 64 * 9}


@pytest.mark.parametrize("height", [1, 2, 3, 4, 5])
def test_addresses_fill_the_layout(height):
    places = [merkle.address(height, d, i) for d in range(min(height, 4)) for i in range(16**d)]
    assert len(set(places)) == len(places)
    if height <= 4:
        assert sorted(places) == list(range(merkle.runs_of(height)))


def test_blocks_of_any_height_give_the_same_digests():
    nodes = [hashlib.sha256(bytes([i % 251, i // 251])).digest() for i in range(16**3 - 5)]
    root, paths = tree([n.hex() for n in nodes])
    block, found = merkle.laid_out(nodes, 3)
    assert found.hex() == root
    for at in (0, 15, 16, 300, len(nodes) - 1):
        lefts, rights = merkle.siblings(block, 3, len(nodes), at)
        assert list(zip(lefts, rights)) == [("".join(a), "".join(b)) for a, b in paths[at]]
