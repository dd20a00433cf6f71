"""Mixing sources to target weights: temperature mixing and budgeted block permutations.

A source with token share p gets a weight proportional to p ** a. The exponent a lies between 0
(all sources equal) and 1 (as they are) and is found by bisection: the entropy of the weights falls
with a, and so does the number of times the most repeated source is read.

Each source is then read in epochs. An epoch is a permutation of the source: its documents are
ordered by a seeded hash and fall into blocks of neighbouring places. Whole epochs are read while
the source's part of the budget lasts; of the last one, whole blocks and then documents up to the
budget. Only sums decide that: of spans of blocks, of the blocks of one span, of the documents of one
block. So a source of any size is never gathered in one task, and what is left is one number per
source, the last place that is read.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattspark.llm.common import column, unused, written

WORD = r"[^\x20\x09-\x0D]+"
STEPS = 60  # of the bisection
PLACES = 1 << 60  # of a permutation: 15 hexadecimal digits
DOCS_PER_BLOCK = 4096
BLOCKS_PER_SPAN = 4096


def n_words(text: Column) -> Column:
    """Words of a whole text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place(doc_id: Column, epoch: Column, seed: int) -> Column:
    """Place of a document in the permutation of an epoch, 0 to ``PLACES`` - 1."""
    name = F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long")


def _sums(shares: Column, a: Column) -> Column:
    """Struct of sum(p ** a) as ``z`` and sum(p ** a * ln p) as ``s``, over an array of ln p."""
    zero = F.struct(F.lit(0.0).alias("z"), F.lit(0.0).alias("s"))
    return F.aggregate(
        shares,
        zero,
        lambda acc, lp: F.struct(
            (acc["z"] + F.exp(a * lp)).alias("z"), (acc["s"] + F.exp(a * lp) * lp).alias("s")
        ),
    )


def _entropy(shares: Column, a: Column) -> Column:
    sums = _sums(shares, a)
    return F.log(sums["z"]) - a * sums["s"] / sums["z"]


def _bisect(too_flat) -> Column:
    """The smallest exponent in [0, 1] at which ``too_flat`` no longer holds."""
    half = lambda x: (x["lo"] + x["hi"]) / 2
    step = lambda x, _: F.struct(
        F.when(too_flat(half(x)), half(x)).otherwise(x["lo"]).alias("lo"),
        F.when(too_flat(half(x)), x["hi"]).otherwise(half(x)).alias("hi"),
    )
    start = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)["hi"]


def weights(
    totals: DataFrame,
    entropy_share: float | None,
    max_repeats: float | None,
    budget_tokens: int | None,
) -> DataFrame:
    """``(source, tokens, exponent, weight, target_tokens)`` from ``(source, tokens)``.

    One row per source comes in and goes out; the exponent is the larger of those that the entropy
    target (a share of the largest entropy, that of equal weights) and the limit on repeats ask
    for. Where even 1 misses the entropy, 1 is used. A budget that reads all tokens more than
    ``max_repeats`` times breaks the limit whatever the weights: it raises when the rows are computed.
    Without a budget it is the least under which every source is read whole at least once. Sources
    without tokens get weight 0.
    """
    tokens = F.col("all_tokens")
    one = (
        totals.where("tokens > 0")
        .agg(F.collect_list(F.struct("source", "tokens")).alias("l"), F.sum("tokens").alias("all_tokens"))
        .withColumn("shares", F.transform("l", lambda x: F.log(x["tokens"] / tokens)))
    )
    shares = F.col("shares")
    least, most = F.array_min(shares), F.array_max(shares)
    exponent = F.lit(0.0)
    if entropy_share is not None:
        goal = F.lit(float(entropy_share)) * F.log(F.size(shares).cast("double"))
        exponent = F.greatest(exponent, _bisect(lambda a: _entropy(shares, a) > goal))
    if max_repeats is not None:
        if budget_tokens is None:  # repeats of the smallest source while the largest is read once
            repeats = lambda a: F.exp((a - 1) * (least - most))
        else:
            repeats = lambda a: (
                F.lit(float(budget_tokens)) / tokens * F.exp((a - 1) * least) / _sums(shares, a)["z"]
            )
        exponent = F.greatest(exponent, _bisect(lambda a: repeats(a) > F.lit(float(max_repeats))))
    one = one.withColumn("exponent", exponent).withColumn("z", _sums(shares, F.col("exponent"))["z"])
    if budget_tokens is None:
        budget = tokens * F.col("z") * F.exp((1 - F.col("exponent")) * most)
    else:
        budget = F.lit(float(budget_tokens))
    if budget_tokens is not None and max_repeats is not None:
        over = budget > tokens * F.lit(float(max_repeats))
        message = f"a budget of {budget_tokens} tokens reads some source more than {max_repeats} times"
        budget = F.when(over, F.raise_error(F.lit(message)).cast("double")).otherwise(budget)
    one = one.withColumn("budget", budget)
    each = one.select("exponent", "z", "budget", "all_tokens", F.explode("l").alias("x")).select(
        F.col("x.source").alias("source"), F.col("x.tokens").alias("tokens"), "exponent", "z", "budget", "all_tokens"
    )
    weight = F.exp(F.col("exponent") * F.log(F.col("tokens") / F.col("all_tokens"))) / F.col("z")
    target = F.floor(weight * F.col("budget") + 1e-6).cast("long")
    if budget_tokens is None:  # beyond some 10**9 tokens a double may fall short by one
        target = F.greatest(target, F.col("tokens"))
    return each.select(
        "source",
        "tokens",
        "exponent",
        weight.alias("weight"),
        target.alias("target_tokens"),
    )


def _crossed(sums: DataFrame, level: str, start: Column) -> DataFrame:
    """``source, <level>, before, rest``: the first of a source's parts in which its tokens pass
    ``rest``, if there is one, and the tokens ahead of it. ``start`` counts what the rows leave out."""
    upto = start + F.sum("tokens").over(Window.partitionBy("source").orderBy(level))
    found = sums.withColumn("before", upto - F.col("tokens")).where("before + tokens > rest AND before <= rest")
    first = found.groupBy("source").agg(F.min(F.struct(level, "before", "rest")).alias("c"))
    return written(first.select("source", "c.*"), "cut")


def plan(
    docs: DataFrame,
    entropy_share: float | None = None,
    max_repeats: float | None = None,
    budget_tokens: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """One row per source: ``source, tokens, exponent, weight, target_tokens, full_epochs, last_place``.

    ``full_epochs`` epochs are read whole, and of the next one the documents whose place is at most
    ``last_place`` (-1: none).
    """
    sized = written(docs.select("doc_id", "source", n_words(F.col("text")).alias("tokens")), "sized")
    totals = sized.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("docs"))
    wanted = weights(totals.select("source", "tokens"), entropy_share, max_repeats, budget_tokens)
    blocks = F.ceil(F.col("docs") / F.lit(DOCS_PER_BLOCK)).cast("long")
    wanted = (
        wanted.withColumnRenamed("source", "_source")
        .join(totals.select("source", "docs"), F.col("_source").eqNullSafe(F.col("source")))
        .drop("_source")
        .withColumn("full_epochs", F.expr("target_tokens div tokens"))
        .withColumn("rest", F.col("target_tokens") - F.col("full_epochs") * F.col("tokens"))
        .withColumn("width", F.ceil(F.lit(PLACES) / blocks).cast("long"))
    )
    wanted = written(wanted, "weights")
    keyed = wanted.select(F.col("source").alias("_source"), "full_epochs", "rest", "width")
    last = sized.join(keyed, F.col("source").eqNullSafe(F.col("_source")))
    last = last.withColumn("place", place(F.col("doc_id"), F.col("full_epochs"), seed))
    last = last.select("source", "tokens", "rest", F.expr("place div width").alias("block"), "place")
    per_block = written(last.groupBy("source", "block", "rest").agg(F.sum("tokens").alias("tokens")), "blocks")
    per_block = per_block.withColumn("span", F.expr(f"block div {BLOCKS_PER_SPAN}"))
    per_span = per_block.groupBy("source", "span", "rest").agg(F.sum("tokens").alias("tokens"))
    spans = _crossed(per_span, "span", F.lit(0).cast("long"))
    spans = spans.select(F.col("source").alias("_source"), F.col("span").alias("_span"), F.col("before").alias("start"))
    near = per_block.join(spans, F.col("source").eqNullSafe(F.col("_source")) & (F.col("span") == F.col("_span")))
    cut = _crossed(near, "block", F.col("start"))
    cut = cut.select(F.col("source").alias("_source"), "block", "before", F.col("rest").alias("_rest"))
    inside = last.withColumnRenamed("block", "_block").join(
        cut, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_block") == F.col("block"))
    )
    by_place = inside.groupBy("source", "place", "before", "_rest").agg(F.sum("tokens").alias("tokens"))
    upto = F.col("before") + F.sum("tokens").over(Window.partitionBy("source").orderBy("place"))
    fits = by_place.withColumn("upto", upto).where("upto <= _rest")
    fits = fits.groupBy("source").agg(F.max("place").alias("inner"))
    fits = fits.withColumnRenamed("source", "_fits")
    starts = (
        wanted.join(cut.select("_source", "block"), F.col("source").eqNullSafe(F.col("_source")), "left")
        .drop("_source")
        .join(fits, F.col("source").eqNullSafe(F.col("_fits")), "left")
    )
    last_place = F.coalesce("inner", F.col("block") * F.col("width") - 1, F.lit(-1).cast("long"))
    return starts.select(
        "source", "tokens", "exponent", "weight", "target_tokens", "full_epochs", last_place.alias("last_place")
    )


def mix(
    docs: DataFrame,
    entropy_share: float | None = None,
    max_repeats: float | None = None,
    budget_tokens: int | None = None,
    seed: int = 0,
) -> DataFrame:
    """The mixed rows: all columns of ``docs`` and ``mix_epoch``, ``mix_place``, ``n_tokens``.

    A document comes once per epoch that reads it; sorting a source by epoch and place gives its
    permutations. A null source is a source. Documents without words cost nothing and come with
    every epoch that reads their place; a source of such documents only comes once. Rows that
    repeat an id share their place and are read together. Columns with the names of the three
    added ones are replaced. An empty table gives no rows.
    """
    added = ("mix_epoch", "mix_place", "n_tokens")
    decided = written(plan(docs, entropy_share, max_repeats, budget_tokens, seed), "mix_plan")
    kept = docs.select(*[column(c) for c in docs.columns if c not in added])
    name = unused("_mix", kept.columns)
    decided = decided.select(F.struct(F.col("source").alias("s"), "full_epochs", "last_place").alias(name))
    of = lambda field: F.col(name)[field]
    rows = kept.join(decided, kept["source"].eqNullSafe(of("s")), "left")
    last = F.coalesce(of("full_epochs"), F.lit(0).cast("long"))
    rows = rows.withColumn("mix_epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    rows = rows.withColumn("mix_place", place(F.col("doc_id"), F.col("mix_epoch"), seed))
    whole = F.col(name).isNull() | (F.col("mix_epoch") < of("full_epochs"))
    rows = rows.where(whole | (F.col("mix_place") <= of("last_place")))
    return rows.drop(name).withColumn("n_tokens", n_words(F.col("text")))
