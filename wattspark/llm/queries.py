"""Registered queries of the operators in this folder, with SQL for DuckDB where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from wattspark.llm import (
    decontaminate,
    langid,
    maxent,
    merkle,
    mixing,
    quality,
    sharding,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_alignment,
    token_rollup,
    toxicity,
)
from wattspark.llm.common import table, written
from wattspark.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def remainder(divisor: int):
    """crc32 of the id as text, modulo ``divisor``; a null id counts as empty."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


# 1 ---------------------------------------------------------------------------------------------

_LEAKS_SQL = r"""
WITH words AS (
  SELECT {id}, list_filter(string_split_regex(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
  FROM {table} WHERE text IS NOT NULL AND {id} IS NOT NULL)
SELECT DISTINCT {id}, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS shingle
FROM (SELECT {id}, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM words WHERE len(w) > 0)
"""


@query(
    "op1_benchmark_decontamination",
    f"""
WITH d AS ({_LEAKS_SQL.format(id="doc_id", table="documents")}),
     b AS ({_LEAKS_SQL.format(id="item_id", table="benchmark")}),
     n AS (SELECT item_id, count(*) AS n_shingles FROM b GROUP BY item_id)
SELECT d.doc_id, b.item_id, any_value(n_shingles) AS n_shingles, count(*) AS n_shared,
       round(count(*) / any_value(n_shingles), 6) AS containment
FROM b JOIN d USING (shingle) JOIN n USING (item_id)
GROUP BY d.doc_id, b.item_id HAVING count(*) >= 0.8 * any_value(n_shingles) - 1e-9
""",
)
def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("containment", F.round("containment", 6))


# 2 ---------------------------------------------------------------------------------------------


@query("op2_substring_dedup")
def substring_dedup_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents"), length=35).drop("kept")


# 3 ---------------------------------------------------------------------------------------------


def language_model(docs: DataFrame) -> langid.Model:
    """Trained on the documents whose remainder is not 2; lang labels them and is never an input."""
    return langid.fit(docs.where(remainder(4) != 2).select("doc_id", "text", "lang"))


@query("op3_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), language_model(docs), keep=["doc_id"])
    return found.select("doc_id", (remainder(4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


# 4 ---------------------------------------------------------------------------------------------


@query("op4_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicated(table(spark, sf_dir, "documents"), length=100).drop("kept")


# 5 ---------------------------------------------------------------------------------------------


@query("op5_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels train only where the remainder is not 0, and are never inputs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    model = toxicity.fit(docs, labels.where(remainder(5) != 0))
    found = toxicity.scores(docs, model)
    return found.select(
        "doc_id", (remainder(5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


# 6 ---------------------------------------------------------------------------------------------


def _sql_text(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


_QUALITY_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {_sql_text(quality.WORD)}) AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, {_sql_text(quality.WORD)})) AS filled
  FROM documents),
windows AS (
  SELECT r, i, array_to_string(words[i + 1 : i + 5], ' ') AS w
  FROM (SELECT r, words, unnest(range(0, len(words) - 4)) AS i FROM d WHERE len(words) >= 5)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) >= 2),
repeated AS (
  SELECT r, count(DISTINCT i + j)::BIGINT AS n FROM twice, (SELECT unnest(range(0, 5)) AS j) GROUP BY r),
lines AS (
  SELECT r, line, trim(line, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' ') AS bare
  FROM (SELECT r, unnest(filled) AS line FROM d)),
counted AS (
  SELECT *, len(regexp_extract_all(bare, {_sql_text(quality.WORD)})) AS n,
         length(regexp_replace(line, {_sql_text(quality.BLANK)}, '', 'g')) AS shown,
         regexp_matches(bare, {_sql_text(quality.SENTENCE_END)}) AS ended,
         len(regexp_extract_all(bare, {_sql_text(quality.SEPARATORS)})) AS seps FROM lines),
judged AS (
  SELECT *, (NOT ended AND n < 5) OR len(regexp_extract_all(bare, {_sql_text(quality.ODD)})) > 0.25 * shown
         OR (seps >= 2 AND n <= 4 * (seps + 1))
         OR (regexp_matches(bare, {_sql_text(quality.CONTROLS)}) AND n <= 10 AND NOT ended)
         OR regexp_matches(bare, {_sql_text(quality.NOTICES)}) AS bad FROM counted),
lost AS (
  SELECT r, count(*) FILTER (bad) AS n_bad_lines, coalesce(sum(shown) FILTER (bad), 0)::BIGINT AS lost_chars
  FROM judged GROUP BY r),
base AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(filled) - len(list_distinct(filled)))::BIGINT AS n_dup_lines,
         coalesce(repeated.n, 0) AS n_repeat_words, len(filled)::BIGINT AS n_lines,
         coalesce(n_bad_lines, 0)::BIGINT AS n_bad_lines, coalesce(lost_chars, 0)::BIGINT AS lost_chars
  FROM d LEFT JOIN repeated USING (r) LEFT JOIN lost USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND lost_chars <= 0.5 * word_chars AS kept
FROM base
"""


@query("op6_quality_rules", _QUALITY_SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean(table(spark, sf_dir, "documents")).drop("clean_text")


# 7 ---------------------------------------------------------------------------------------------


@query("op7_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words_per_shingle=3, distance=3)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexed.alias("fingerprint"), "component_id")


# 8 ---------------------------------------------------------------------------------------------


@query("op8_sharding")
def sharding_by_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    found = sharding.shuffle_to_shards(docs, shards=24, seed=20)
    return found.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


# 9 ---------------------------------------------------------------------------------------------


VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@query("op9_token_counts")
def token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """A rollup after a load, the removal of exact copies and a revised word count.

    All documents are inserted under two tokenizer versions. Then copies go: all rows are deleted and
    one of each text is inserted again, that of the smallest id (ids before none, then the first source
    and language), in one signed batch. Then the remaining counts of ``words`` are revised to leave out
    runs of mere punctuation. Two batches are committed twice, which changes nothing. ``vocabulary``
    is read by the driver. Null and empty texts are copies of one another, with 0 tokens.
    """
    counters = {
        "bpe": token_rollup.Bpe.from_file(vocabulary),
        "words": token_rollup.words,
        "letter_words": token_rollup.letter_words,
    }
    counted = written(token_rollup.counts(table(spark, sf_dir, "documents"), counters), "token_counts")
    kept = written(token_rollup.without_copies(counted), "one_of_each_text")
    rollup = token_rollup.Rollup(spark, scratch_dir(spark, "token_rollup"))
    versions = (("byte_bpe_50k", "bpe"), ("words", "words"))
    load = [token_rollup.inserted(counted, v, c) for v, c in versions]
    removal = [token_rollup.deleted(counted, v, c) for v, c in versions]
    removal += [token_rollup.inserted(kept, v, c) for v, c in versions]
    rollup.commit("load", *load)
    rollup.commit("removal", *removal)
    rollup.commit("load", *load)
    rollup.commit("recount", token_rollup.revised(kept, "words", "words", "letter_words"))
    rollup.commit("removal", *removal)
    rollup.compact()
    return rollup.totals()


# 10 --------------------------------------------------------------------------------------------

MIX = {"entropy_share": 0.97, "max_repeats": 4.0, "seed": 11}

_MIX_SQL = r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS n_tokens FROM documents),
totals AS (SELECT source, sum(n_tokens)::BIGINT AS tokens FROM sized GROUP BY source),
shares AS (SELECT source, tokens, ln(tokens / sum(tokens) OVER ()) AS lp, sum(tokens) OVER () AS every
           FROM totals WHERE tokens > 0),
lists AS (SELECT list(lp) AS lps, count(*) AS k, min(lp) AS least, max(lp) AS most FROM shares),
flat(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN up THEN (lo + hi) / 2 ELSE lo END, CASE WHEN up THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT i, lo, hi,
               (SELECT ln(sum(exp((lo + hi) / 2 * lp))) - (lo + hi) / 2 * sum(exp((lo + hi) / 2 * lp) * lp) / sum(exp((lo + hi) / 2 * lp)) FROM shares)
                 > 0.97 * (SELECT ln(k) FROM lists) AS up
        FROM flat WHERE i < 60)),
few(i, lo, hi) AS (
  SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
  UNION ALL
  SELECT i + 1, CASE WHEN up THEN (lo + hi) / 2 ELSE lo END, CASE WHEN up THEN hi ELSE (lo + hi) / 2 END
  FROM (SELECT i, lo, hi,
               (SELECT exp(((lo + hi) / 2 - 1) * (least - most)) FROM lists) > 4.0 AS up
        FROM few WHERE i < 60)),
chosen AS (SELECT greatest((SELECT hi FROM flat WHERE i = 60), (SELECT hi FROM few WHERE i = 60)) AS a),
z AS (SELECT a, sum(exp(a * lp)) AS z, any_value(every) * sum(exp(a * lp)) * exp((1 - a) * max(lp)) AS budget
      FROM shares, chosen GROUP BY a),
targets AS (
  SELECT source, tokens, floor(exp(a * lp) / z.z * budget + 1e-6)::BIGINT AS target FROM shares, z),
epochs AS (SELECT source, tokens, target // tokens AS whole, target % tokens AS rest FROM targets),
rows AS (
  SELECT doc_id, s.source, n_tokens, unnest(range(0, coalesce(whole, 0) + 1)) AS epoch, whole, rest
  FROM sized s LEFT JOIN epochs e ON s.source IS NOT DISTINCT FROM e.source),
placed AS (
  SELECT *, ('0x' || md5('11:' || epoch || ':' || coalesce(doc_id::VARCHAR, ''))[:15])::BIGINT AS place FROM rows),
summed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY source, epoch ORDER BY place) AS upto FROM placed)
SELECT doc_id, source, epoch, place, n_tokens FROM summed WHERE whole IS NULL OR epoch < whole OR upto <= rest
"""


@query("op10_source_mixing", _MIX_SQL)
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, **MIX)
    return mixed.select(
        "doc_id", "source", F.col("mix_epoch").alias("epoch"), F.col("mix_place").alias("place"), "n_tokens"
    )


# 11 --------------------------------------------------------------------------------------------


@query("op11_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learnt from the documents whose remainder is not 2."""
    return maxent.scored(table(spark, sf_dir, "documents"), remainder(7) == 2)


# 12 --------------------------------------------------------------------------------------------


@query("op12_merkle_manifest")
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, checked with the document as it is or, where 5 divides the checksum of
    the id, with its A-Z made small; a row without an id is left as it is."""
    docs = table(spark, sf_dir, "documents")
    values = ("doc_id", "source", "lang", "n_chars", "text")
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.col("doc_id").isNotNull() & (remainder(5) == 0)
    read = merkle.leaf(*(F.when(tampered, small).otherwise(F.col(v)) if v == "text" else F.col(v) for v in values))
    carried = F.struct(F.col("doc_id"), F.unhex(read).alias("read"))
    found = merkle.manifest(docs, values, carried=carried).proofs()
    lefts, rights = F.col("lefts"), F.col("rights")
    checked = found.select(
        F.col("carried.doc_id").cast("long").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(lefts, rights).alias("proof_sha256"),
        merkle.folded(F.lower(F.hex("carried.read")), lefts, rights).alias("folded_root"),
    )
    return checked.withColumn("verified", F.col("folded_root") == F.col("root"))


# 13 --------------------------------------------------------------------------------------------

TOKENIZERS = "/opt/tokenizers"


@query("op13_token_alignment")
def token_alignment_counts(spark: SparkSession, sf_dir: str, folder: str = TOKENIZERS) -> DataFrame:
    """``folder`` holds the vocabularies, where the driver can read them."""
    docs = table(spark, sf_dir, "documents")
    return token_alignment.aligned(docs, token_alignment.Tokenizers.from_folder(folder))
