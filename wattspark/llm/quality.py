"""Line-first cleaning: rules per line, failed lines removed, documents that lose too much rejected.

A line fails

- the punctuation rule if it is short and does not end a sentence, or if symbols make up more than
  a share of what it shows,
- the navigation rule if it reads like a menu: separators between short entries, or few words with
  a phrase of page controls,
- the boilerplate rule if it holds a phrase of notices, licences or scripts.

Lines without a word neither fail nor count. What is left is the cleaned text. A document is
rejected if the removed lines held more than ``max_loss`` of the characters of its words, or if it
fails the base rules on length and repetition.

DataFrame functions only; everything of a document is computed within its row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"
# What the rules look for.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = r"[#*$%&|<>]"
SENTENCE_END = r"""[.!?:;…"”'’»)\]。！？]\z"""
ODD = r"[#*$%&|<>{}\[\]\\^~=+_@/`]"
SEPARATORS = r" [|>»›·•/] "
CONTROLS = (
    r"(?i)\b(home|menu|log ?in|sign ?(in|up)|search|next|previous|back to top|skip to (main )?content|read more"
    r"|click here|share (this|on)|subscribe|site ?map|contact us|about us|add to cart|follow us)\b"
)
NOTICES = (
    r"(?i)(all rights reserved|copyright|\(c\) ?[12][0-9]{3}|©|privacy policy|terms (of|and) (use|service|conditions)"
    r"|cookie (policy|settings|consent)|uses cookies|enable javascript|lorem ipsum|licen[cs]ed under|released under"
    r"|spdx-license-identifier|powered by|this page (was|is) (generated|intentionally))"
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def n_chars(words: Column) -> Column:
    """Code points of all words."""
    return F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w))


def window_codes(words: Column, k: int = 5) -> Column:
    """64-bit hash of every window of ``k`` words; empty for fewer words."""
    starts = F.sequence(F.lit(0), F.size(words) - k)
    codes = F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + j) for j in range(k))))
    return F.when(F.size(words) >= k, codes).otherwise(F.array().cast("array<bigint>"))


def n_repeat_words(codes: Column, k: int = 5) -> Column:
    """Words in windows of ``k`` words that occur twice or more in the text, the first included.

    Most texts repeat nothing and are done once the hashes are known to be distinct. Otherwise hashes
    are sorted with their places, and the places of equal neighbours cover the words.
    """

    def covered(codes: Column) -> Column:
        filed = F.array_sort(F.transform(codes, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
        return let(filed, repeated)

    def repeated(filed: Column) -> Column:
        def twice(e: Column, j: Column) -> Column:
            return F.coalesce(F.get(filed, j + 1)["x"] == e["x"], F.lit(False)) | F.coalesce(
                F.get(filed, j - 1)["x"] == e["x"], F.lit(False)
            )

        places = F.array_sort(F.transform(F.filter(filed, twice), lambda e: e["i"]))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        step = lambda a, i: F.struct(
            (a["n"] + i + k - F.greatest(a["end"], i)).alias("n"), (i + k).alias("end")
        )
        return F.aggregate(places, start, step)["n"]

    distinct = F.size(F.array_distinct(codes)) == F.size(codes)
    return F.when(distinct, F.lit(0).cast("long")).otherwise(covered(codes))


def line_fails(line: Column, short_words: int, odd_share: float, menu_words: int) -> Column:
    """Whether a line with a word fails one of the three rules."""
    bare = F.trim(line, F.lit(BLANKS))

    # the cheap tests come first: what follows a decided one is not evaluated
    def rules(bare: Column) -> Column:
        ended = bare.rlike(SENTENCE_END)
        n = F.regexp_count(bare, F.lit(WORD))
        odd = F.regexp_count(bare, F.lit(ODD))
        shown = F.length(F.regexp_replace(line, BLANK, ""))
        separators = F.regexp_count(bare, F.lit(SEPARATORS))
        menu = let(separators, lambda x: (x >= 2) & (n <= 4 * (x + 1)))
        symbols = let(odd, lambda x: (x > 0) & (x > F.lit(odd_share) * shown))
        few = ~ended & let(n, lambda x: (x < short_words) | ((x <= menu_words) & bare.rlike(CONTROLS)))
        return few | symbols | menu | bare.rlike(NOTICES)

    return let(bare, rules)


def clean(
    docs: DataFrame,
    min_words: int = 10,
    max_repeat_percent: int = 20,
    short_words: int = 5,
    odd_share: float = 0.25,
    menu_words: int = 10,
    max_loss: float = 0.5,
) -> DataFrame:
    """``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines,
    n_bad_lines, lost_chars, clean_text, kept`` for every row.

    A null or empty text has no words, all counts 0, fails the base rules and is not kept; its
    cleaned text is empty. Rows are judged one by one, so repeated rows are alike and other columns
    are not read. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    rows = rows.withColumn("words", words_of(F.col("text"))).withColumn("lines", F.split("text", "\n"))
    verdict = lambda x: F.when(x.rlike(WORD), line_fails(x, short_words, odd_share, menu_words))
    judged = F.transform("lines", lambda x: F.struct(x.alias("line"), verdict(x).alias("bad")))
    those = lambda test: F.transform(F.filter("judged", test), lambda x: x["line"])
    rows = rows.withColumn("judged", judged)
    rows = rows.withColumn("full", those(lambda x: x["bad"].isNotNull())).withColumn("bad", those(lambda x: x["bad"]))
    rows = rows.withColumn("codes", window_codes(F.col("words")))
    lost = F.aggregate(
        "bad", F.lit(0).cast("long"), lambda n, x: n + F.length(F.regexp_replace(x, BLANK, ""))
    )
    left = those(lambda x: ~F.coalesce(x["bad"], F.lit(False)))
    n = F.col("n_words")
    return (
        rows.select(
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            n_chars(F.col("words")).alias("word_chars"),
            F.length(F.regexp_replace("text", SYMBOLS.replace("[", "[^") + "+", "")).cast("long").alias("n_symbols"),
            (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
            n_repeat_words(F.col("codes")).alias("n_repeat_words"),
            F.size("full").cast("long").alias("n_lines"),
            F.size("bad").cast("long").alias("n_bad_lines"),
            lost.alias("lost_chars"),
            F.array_join(F.when(F.size("bad") == 0, F.col("lines")).otherwise(left), "\n").alias("clean_text"),
        )
        .withColumn("base_failed", (n < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * n))
        .withColumn("kept", ~F.col("base_failed") & (F.col("lost_chars") <= F.lit(max_loss) * F.col("word_chars")))
    )
