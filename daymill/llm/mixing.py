"""Mixing sources to target weights by temperature.

A source's share of all tokens is raised to an exponent between 0 and 1 and normalised: 1 keeps the natural mix, 0
makes all sources equal. The exponent is found by bisection over steps of 1 / ``STEPS``: the largest that reaches the
target entropy (a part of the most that so many sources can have), or the smallest that keeps every source's
repetitions within the limit if that is larger. The budget is the least at which each source's weight covers all
its documents once, so nothing is dropped: the source that the weights favour least is passed once, others
``epochs`` times.

Weights become a budgeted block permutation: each pass of a source is a permutation of its documents by a hash, whose
running tokens place it in the source's budget; the mix is cut into blocks of equal budget, and every block gets from
each source the part of its permutation that falls there, so each block has the target mix. The last pass stops
when the budget is used up.

Running sums never put a source into one task: tokens are summed by source and range of the hash, and only these sums
(``RANGES`` a source at most) run over a window. Bisection evaluates all sources in aggregates, without collecting
them. DataFrame functions only.

Nulls: a null source is a source of its own; a null text has no tokens, and a document without tokens is placed
where its hash stands. Repeated rows are placed each on its own. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialise, text_or_empty

STEPS = 1024
RANGES = 4096
BLOCKS = 256
TARGET_ENTROPY = 0.95
REPETITIONS = 2.0


def tokens(text_col: str = "text") -> Column:
    """The number of words in a text."""
    return F.size(F.regexp_extract_all(text_or_empty(text_col), F.lit(r"[^ \t-\r]++"), F.lit(0))).cast("long")


def exponent(sums: DataFrame, target: float = TARGET_ENTROPY, repetitions: float = REPETITIONS) -> float:
    """The exponent for (source, tokens); each step of a bisection is one small aggregate."""
    known = sums.filter("tokens > 0")
    n, total, most, least = known.agg(F.count("*"), F.sum("tokens"), F.max("tokens"), F.min("tokens")).first()
    if not n or n == 1:
        return 1.0

    def enough(step: int) -> bool:
        """Entropy falls as the exponent grows."""
        a = step / STEPS
        raised = known.select(F.pow(F.col("tokens") / F.lit(float(total)), F.lit(a)).alias("x"))
        s, xlogx = raised.agg(F.sum("x"), F.sum(F.col("x") * F.log("x"))).first()
        return math.log(s) - xlogx / s >= target * math.log(n) - 1e-12

    low, high = 0, STEPS
    if enough(high):
        low = high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if enough(middle) else (low, middle)
    # A source of the least tokens is passed (most / least) ** (1 - exponent) times.
    limited = 1 - math.log(max(repetitions, 1.0)) / math.log(most / least) if most > least else 0.0
    return min(1.0, max(low, math.ceil(max(0.0, limited) * STEPS - 1e-9)) / STEPS)


def plan(sums: DataFrame, target: float = TARGET_ENTROPY, repetitions: float = REPETITIONS) -> DataFrame:
    """(source, tokens, weight, epochs, budget) of each source in (source, tokens)."""
    a = exponent(sums, target, repetitions)
    most, norm = sums.agg(F.max("tokens"), F.sum(F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(a))).otherwise(0.0))).first()
    most = most or 0
    known = F.col("tokens") > 0
    epochs = F.when(known, F.pow(F.lit(float(most)) / F.col("tokens"), F.lit(1 - a))).otherwise(F.lit(1.0))
    weight = F.when(known, F.pow(F.col("tokens").cast("double"), F.lit(a)) / F.lit(float(norm or 1.0))).otherwise(F.lit(0.0))
    return sums.select("source", "tokens", weight.alias("weight"), epochs.alias("epochs")).withColumn("budget", F.floor(F.col("epochs") * F.col("tokens")).cast("long"))


def mix(docs: DataFrame, source_col: str = "source", text_col: str = "text", id_col: str = "doc_id", target: float = TARGET_ENTROPY, repetitions: float = REPETITIONS, blocks: int = BLOCKS, seed: int = 42) -> DataFrame:
    """docs, each row once or more, with __mill_block, __mill_epoch, __mill_at and __mill_tokens.

    __mill_at is the row's place in its source's budget, in tokens before it; sort by block and hash to read the mix.
    """
    own = [F.col(f"`{c}`") for c in docs.columns]
    placed = docs.select(*own, tokens(text_col).alias("__mill_tokens"), F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("__mill_hash"))
    sizes = placed.select(F.col(source_col).alias("source"), F.col("__mill_tokens").alias("tokens"), F.col("__mill_hash").alias("hash"))
    bits = RANGES.bit_length() - 1
    range_of = lambda h: F.shiftrightunsigned(h, 64 - bits)
    # Ranges of the hash in unsigned order; ties of the hash share their place.
    sizes = materialise(sizes.groupBy("source", "hash").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "mix-sizes")
    sums = sizes.groupBy("source", range_of(F.col("hash")).alias("range")).agg(F.sum("tokens").alias("tokens"))
    sums = materialise(sums, "mix-sums")
    plans = materialise(plan(sums.groupBy("source").agg(F.sum("tokens").alias("tokens")), target, repetitions), "mix-plan")
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "range", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source", "range").orderBy("hash").rowsBetween(Window.unboundedPreceding, -1)
    running = sizes.withColumn("range", range_of(F.col("hash"))).withColumn("ahead", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    starts = starts.withColumnRenamed("source", "of_source").join(plans, F.col("of_source").eqNullSafe(plans["source"]))
    starts = starts.select("of_source", F.col("range").alias("of_range"), "start", F.col("tokens").alias("__mill_of"), F.col("budget").alias("__mill_budget"))
    at = running.join(starts, (F.col("range") == F.col("of_range")) & F.col("source").eqNullSafe(F.col("of_source")))
    at = at.select(F.col("source").alias("__mill_source"), F.col("hash").alias("__mill_same"), (F.col("start") + F.col("ahead")).alias("__mill_place"), "__mill_of", "__mill_budget")
    # Pass e of a document stands at e * (tokens of its source) + its place; it is in if that is within the budget.
    of, budget = F.col("__mill_of"), F.col("__mill_budget")
    passes = F.when(of > 0, F.greatest(F.lit(1), F.ceil((budget - F.col("__mill_place")) / of))).otherwise(F.lit(1)).cast("int")
    joined = placed.join(at, (F.col("__mill_hash") == F.col("__mill_same")) & F.col(source_col).eqNullSafe(F.col("__mill_source")))
    each = joined.select(*own, "__mill_tokens", "__mill_hash", "__mill_place", of, budget, F.explode(F.sequence(F.lit(0), passes - 1)).alias("__mill_epoch"))
    place = F.col("__mill_epoch") * of + F.col("__mill_place")
    block = F.when(budget > 0, F.least(F.lit(blocks - 1), F.floor(place * F.lit(float(blocks)) / budget))).otherwise(F.pmod("__mill_hash", F.lit(blocks)))
    return each.select(*own, block.cast("int").alias("__mill_block"), "__mill_epoch", place.cast("long").alias("__mill_at"), "__mill_tokens")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix's documents with their own columns only, repeated as their source's weight asks."""
    return mix(docs, **how).select(*[F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, source, block, epoch, at, n_tokens) of every row of the mix."""
    named = [F.col(f"__mill_{c}").alias(c) for c in ("block", "epoch", "at")]
    return mix(docs, **how).select("doc_id", "source", *named, F.col("__mill_tokens").alias("n_tokens"))
