"""Token counts as rollups kept up to date by signed deltas.

Totals per source, language and tokenizer version are sums, so a change of the corpus only adds its
delta: +1 document and its tokens for an insert, the negative for a delete, both for a revised
count. A batch of changes is summed to one row per group before it is stored, under the name of
the batch. Committing a batch again adds nothing; under the same name other changes raise. One that
was cut short does not count and is written anew. Totals add up the batches, which can be folded.
"""

from __future__ import annotations

import base64
import os
import re
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattspark.llm.common import bytes_of

GROUP = ("source", "lang", "version")
SCHEMA = "source string, lang string, version string, docs long, tokens long"
# Fixed value: how the byte-level vocabulary below splits a text before merging bytes.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

Counter = Callable[[list[str]], list[int]]


class Bpe:
    """Byte-pair counter over a vocabulary of ranks; the ranks travel with it, the file does not."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.ranks, self.pattern, self._encoding = ranks, pattern, None

    @classmethod
    def from_file(cls, path: str, pattern: str = PATTERN) -> Bpe:
        """Ranks from a file that the driver can read: a line per token, base64 and rank."""
        if not os.path.isfile(path):
            raise FileNotFoundError(f"no byte-pair vocabulary at {path}; give the path of one")
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern, "_encoding": None}

    def __call__(self, texts: list[str]) -> list[int]:
        if self._encoding is None:
            import tiktoken

            self._encoding = tiktoken.Encoding(
                "ranks", pat_str=self.pattern, mergeable_ranks=self.ranks, special_tokens={}
            )
        return [len(self._encoding.encode_ordinary(t)) for t in texts]


def words(texts: list[str]) -> list[int]:
    """Runs without white space."""
    return [len(t.encode().split()) for t in texts]


def letter_words(texts: list[str]) -> list[int]:
    """Runs without white space that hold a letter, a digit or a longer character."""
    seen = re.compile(rb"[0-9A-Za-z\x80-\xff]").search
    return [sum(1 for w in t.encode().split() if seen(w)) for t in texts]


def counts(docs: DataFrame, counters: dict[str, Counter]) -> DataFrame:
    """``doc_id, source, lang, text_hash`` and one long column per counter, over whole texts.

    A null text counts as empty, 0 tokens. Other columns are not read.
    """
    names = list(counters)
    sent = docs.sparkSession.sparkContext.broadcast(counters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = sent.value
        for batch in batches:
            texts = batch.column(4).to_pylist()
            found = [pa.array(np.array(use[n](texts), np.int64)) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], *found], ["doc_id", "source", "lang", "text_hash", *names]
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        F.sha2(bytes_of(F.col("text")), 256).alias("text_hash"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"),
    )
    schema = "doc_id long, source string, lang string, text_hash string"
    return rows.mapInArrow(run, schema + "".join(f", `{n}` long" for n in names))


def inserted(counted: DataFrame, version: str, column: str) -> DataFrame:
    """Changes that add documents; ``column`` holds their tokens under ``version``."""
    return counted.select(
        "source", "lang", F.lit(version).alias("version"), F.lit(1).alias("sign"), F.col(column).alias("n_tokens")
    )


def deleted(counted: DataFrame, version: str, column: str) -> DataFrame:
    """Changes that take documents away."""
    return inserted(counted, version, column).withColumn("sign", F.lit(-1))


def revised(counted: DataFrame, version: str, old: str, new: str) -> DataFrame:
    """Changes that replace the count of documents."""
    return deleted(counted, version, old).unionByName(inserted(counted, version, new))


class Rollup:
    """The rollup kept under ``path``, a folder that all executors reach.

    ``deltas`` holds what batches wrote, ``commits`` a small file per committed batch that names its
    delta and its digest, ``bases`` sums of batches that were folded together. A delta counts from the
    moment its commit file is there, whatever files Spark itself leaves or does not leave.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _path(self, *names: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _note(self, text: str, *names: str) -> bool:
        """Make a small file; False if it is there."""
        system, path = self._path(*names)
        if system.exists(path):
            return False
        try:
            out = system.create(path, False)
        except Py4JJavaError:
            if system.exists(path):  # another writer was faster
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _notes(self, folder: str) -> dict[str, list[str]]:
        """Words of every small file of a folder, by the file's name; empty ones were cut short."""
        system, path = self._path(folder)
        if not system.exists(path):
            return {}
        rows = self.spark.read.text(f"{self.path}/{folder}", wholetext=True)
        found = rows.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("name"), "value")
        return {r["name"]: r["value"].split() for r in found.toLocalIterator() if r["value"].split()}

    def _commit(self, batch: str) -> list[str]:
        """Folder and digest of a committed batch, else nothing."""
        system, path = self._path("commits", batch)
        if not system.exists(path):
            return []
        found = self.spark.read.text(f"{self.path}/commits/{batch}", wholetext=True).first()
        if found is None or len(found[0].split()) < 2:  # cut while it was written
            system.delete(path, False)
            return []
        return found[0].split()

    def committed(self, batch: str) -> bool:
        return bool(self._commit(batch))

    def commit(self, batch: str, *changes: DataFrame) -> bool:
        """Store the delta of a batch; False if it had been committed before: then nothing is added.

        Changes have ``source, lang, version, sign, n_tokens``; null group values are groups. A
        null count adds 0 tokens. Changes are summed before they are shuffled, so no group is
        gathered. An empty batch is committed like any other. A name that was committed with another
        delta raises ValueError. Every attempt writes a folder of its own, so of two writers of one
        name one commits and the other is told so.
        """
        if not re.fullmatch(r"[A-Za-z0-9][\w-]*", batch):
            raise ValueError("a batch is named by letters, digits, _ and -, and begins with a letter or a digit")
        rows = reduce(DataFrame.unionByName, changes)
        sign = F.col("sign").cast("long")
        tokens = F.sum(sign * F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long"))
        delta = rows.groupBy(*GROUP).agg(F.sum(sign).alias("docs"), tokens.alias("tokens"))
        known = self._commit(batch)
        if not known:
            folder = f"{batch}.{uuid.uuid4().hex}"
            delta.write.parquet(f"{self.path}/deltas/{folder}")
            delta = self.spark.read.schema(SCHEMA).parquet(f"{self.path}/deltas/{folder}")
            digest = _digest(delta)
            if self._note(f"{folder} {digest}", "commits", batch):
                return True
            known = self._commit(batch)
        else:
            digest = _digest(delta)
        if known[1:] != [digest]:
            raise ValueError(f"batch {batch} was committed with other changes")
        return False

    def _base(self) -> tuple[str | None, set[str]]:
        """The newest base and the batches that it holds."""
        notes = self._notes("folded")
        if not notes:
            return None, set()
        newest = max(notes, key=int)
        return notes[newest][0], set(notes[newest][1:])

    def _sums(self) -> tuple[DataFrame, set[str]]:
        base, folded = self._base()
        commits = self._notes("commits")
        paths = [f"{self.path}/deltas/{c[0]}" for b, c in sorted(commits.items()) if b not in folded]
        paths += [f"{self.path}/bases/{base}"] if base else []
        if not paths:
            return self.spark.createDataFrame([], SCHEMA), set()
        rows = self.spark.read.schema(SCHEMA).parquet(*paths)
        sums = rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return sums.where("docs != 0 OR tokens != 0"), set(commits) | folded

    def totals(self) -> DataFrame:
        """``source, lang, version, docs, tokens``; groups whose documents are all gone are left out."""
        return self._sums()[0]

    def compact(self) -> None:
        """Fold all committed batches into one base, so that totals no longer add each of them up.

        A folded batch stays committed, and its delta stays for readers that have begun. The base
        counts once its note is there. One process at a time compacts; batches may be committed
        meanwhile and are not folded then.
        """
        sums, folded = self._sums()
        base = uuid.uuid4().hex
        sums.write.parquet(f"{self.path}/bases/{base}")
        number = max(map(int, self._notes("folded")), default=0) + 1
        if not self._note(" ".join([base, *sorted(folded)]), "folded", str(number)):
            raise RuntimeError("another process compacts this rollup")


def _digest(delta: DataFrame) -> str:
    """Of the rows of a delta, in whatever order."""
    row = F.xxhash64(*GROUP, *(F.col(c).isNull() for c in GROUP), "docs", "tokens")
    found = delta.agg(F.count("*").alias("n"), F.sum(row.cast("decimal(20,0)")).alias("s")).first()
    return f"{found['n']}:{found['s'] or 0}"


def without_copies(counted: DataFrame) -> DataFrame:
    """One row of each text: of equal texts that of the smallest id, ids before none, then of the first
    source and language, none first. Rows that agree in all these are alike. A text of any number of
    copies is aggregated before it is shuffled, and nothing is joined."""
    rest = [c for c in counted.columns if c not in ("text_hash", "doc_id")]
    order = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "source", "lang", *[c for c in rest if c not in GROUP])
    best = counted.groupBy("text_hash").agg(F.min(order).alias("_best"))
    return best.select(*("text_hash" if c == "text_hash" else F.col("_best")[c].alias(c) for c in counted.columns))
