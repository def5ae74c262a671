"""How far the sources of a language are from each other in their words: an audit by Gustavson row accumulation.

A group is the rows of one language and source. A language keeps the terms that are in at least ``least`` of its rows.
A group gives a kept term with ``count`` occurrences the share p = 1 + floor(10**9 (count + 5) / (N + 5 V)), N the count's
sum over the V kept terms; the language as a whole gives it q in the same way. Two groups are as far apart as the sum of
|p - p'| over all kept terms.

The counts are a sparse matrix of groups and terms, held term by term: a posting is a group and its p. Each group's row
is scattered through the postings of its terms into a dense accumulator, one number for each peer; so no pair of postings
becomes a row. A term that a group lacks has the group's zero baseline b = 1 + floor(5 * 10**9 / (N + 5 V)) and no
posting; so what is accumulated is |p - p'| - |p - b'| - |b - p'| + |b - b'| for terms that both have, to which come
|p - b'| - |b - b'| over the own terms of either, from sorted shares and their prefix sums, and V |b - b'|.

The index is cut by term into blocks of ``POSTINGS`` postings, the more the more groups there are; so that a task holds a block and a number for each
group of its language, and its sums meet by pair. The largest part of the result is as large: all pairs of a language's
groups. Terms are counted task by task before the shuffle; a source or a term that most rows have is one more key.

Null text, language and source are empty. Each row is a document, repeated rows and repeated or null ids too. A group
without kept terms has the baseline everywhere; a language without kept terms has distances of 0 and no terms; an empty
table gives an empty result. Other columns are not read. Sums are exact: shares are longs made from decimals, and
accumulated numbers stay under 2**53 for up to 10**15 kept terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialise, small_batches

#: The letters that are lower-cased, and what counts are smoothed with. Other bytes of ASCII stand between terms.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
UNIT, SMOOTH = 10**9, 5

_BYTES = bytes(b + 32 if chr(b) in UPPER else b if b > 127 or chr(b) in LOWER else 32 for b in range(256))

#: A task holds about so many counts before it sends them on.
HELD = 200_000
POSTINGS = (1 << 14, 1 << 20)
#: So many postings are scattered at once.
GATHERED = 1 << 20


def terms(text: str) -> list[bytes]:
    """The terms of a text in order, A-Z lower-cased, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split()


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, term, n, rows): occurrences of each term in each group, and the rows that have it."""
    small_batches(docs.sparkSession)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flush() -> Iterator[pd.DataFrame]:
            for (lang, source), (n, rows) in ((k, v) for k, v in held.items() if v[0]):
                yield pd.DataFrame({"lang": lang, "source": source, "term": [t.decode("utf-8", "surrogatepass") for t in n], "n": [*n.values()], "rows": [rows[t] for t in n]})
            held.clear()

        for batch in batches:
            for lang, source, text in batch.itertuples(index=False):
                n, rows = held.setdefault((lang, source), (Counter(), Counter()))
                own = terms(text)
                n.update(own)
                rows.update(set(own))
            if sum(len(n) for n, _ in held.values()) > HELD:
                yield from flush()
        yield from flush()

    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))]
    found = docs.select(*named).mapInPandas(count, "lang string, source string, term string, n long, rows long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("rows").alias("rows"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(UNIT (n + SMOOTH) / (total + SMOOTH kept)), exactly; null where no term is kept."""
    n, total, kept = (x.cast("decimal(20,0)") for x in (n, total, kept))
    below = (total + F.lit(SMOOTH) * kept).cast("decimal(22,0)")
    above = ((n + F.lit(SMOOTH)).cast("decimal(21,0)") * F.lit(UNIT)).cast("decimal(38,0)")
    return F.when(below > 0, F.lit(1).cast("long") + F.call_function("div", above, below))


def accumulate(postings: pd.DataFrame, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, value): for each pair a < b of groups what a block of postings (term, g, p) adds to V |b - b'|."""
    term, group, p = pd.factorize(postings["term"])[0], postings["g"].to_numpy(np.int64), postings["p"].to_numpy(np.int64)
    by_term = np.argsort(term, kind="stable")
    peer, share_ = group[by_term], p[by_term]
    first = np.searchsorted(term[by_term], np.arange(term.max(initial=-1) + 2))
    by_group = np.argsort(group, kind="stable")
    ends = np.searchsorted(group[by_group], np.arange(len(base) + 1))
    rows, width = [], len(base)
    for g in range(width):
        own = by_group[ends[g] : ends[g + 1]]
        if not len(own):
            continue
        held = np.zeros(width, np.int64)
        lengths = first[term[own] + 1] - first[term[own]]
        upto = np.cumsum(lengths)
        for cut in np.split(np.arange(len(own)), np.flatnonzero(np.diff(upto // GATHERED)) + 1):
            n = lengths[cut]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[term[own[cut]]], n)
            h, x, y = peer[at], np.repeat(p[own[cut]], n), share_[at]
            both = np.abs(x - y) - np.abs(x - base[h]) - np.abs(base[g] - y) + np.abs(base[g] - base[h])
            held += np.bincount(h, weights=both, minlength=width).astype(np.int64)
        sorted_ = np.sort(p[own])
        sums = np.concatenate([[0], np.cumsum(sorted_)])
        k = np.searchsorted(sorted_, base)
        alone = base * k - sums[k] + (sums[-1] - sums[k]) - base * (len(own) - k) - len(own) * np.abs(base[g] - base)
        after = np.arange(width) > g
        rows.append((np.minimum(g, np.arange(width)), np.maximum(g, np.arange(width)), alone + np.where(after, held, 0)))
    a, b, value = (np.concatenate(x) for x in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 3
    return a[a < b], b[a < b], value[a < b]


def audit(docs: DataFrame, least: int = 30, most: int = 50, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) of every group.

    Part ``pair``: item is each other source of the language, value their distance. Part ``term``: item is a term that the
    group has and that is likelier there than in the language, value p - q, the first ``most`` of them. Ranks count from 1
    in each group and part, by falling value and then by item.
    """
    counts = materialise(term_counts(docs, lang_col, source_col, text_col), "divergence-counts")
    in_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("rows").alias("rows")).filter(F.col("rows") >= least).drop("rows")
    kept = materialise(counts.drop("rows").join(in_lang, ["lang", "term"]), "divergence-kept")
    sizes = kept.groupBy("lang").agg(F.count_distinct("term").alias("v"), F.sum("n").alias("total_lang"), F.count("*").alias("postings"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    named = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"))]
    groups = docs.select(*named).distinct().join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").na.fill(0, ["total", "v", "total_lang", "postings"])
    groups = groups.withColumn("g", (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("int"))
    # as many postings to a block as it has sums of pairs to send on, within bounds
    size = F.least(F.lit(POSTINGS[1]), F.greatest(F.lit(POSTINGS[0]), F.pow(F.count("*").over(Window.partitionBy("lang")), F.lit(2))))
    groups = groups.withColumn("base", share(F.lit(0), F.col("total"), F.col("v"))).withColumn("blocks", F.ceil(F.greatest(F.lit(1), F.col("postings")) / size).cast("int"))
    groups = materialise(groups, "divergence-groups")

    shares = kept.join(groups.select("lang", "source", "g", "total", "v", "total_lang", "blocks"), ["lang", "source"])
    shares = shares.select("lang", "source", "term", "g", "blocks", share(F.col("n"), F.col("total"), F.col("v")).alias("p"), share(F.col("n_lang"), F.col("total_lang"), F.col("v")).alias("q"))
    in_group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ahead = shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    ahead = ahead.withColumn("rank", F.row_number().over(in_group)).filter(F.col("rank") <= most)

    def scatter(key: tuple, postings: pd.DataFrame, bases: pd.DataFrame) -> pd.DataFrame:
        base = bases.sort_values("peer")["base"].fillna(0).to_numpy(np.int64)
        if len(postings):
            a, b, value = accumulate(postings, base)
        else:
            a, b, value = (np.zeros(0, np.int64),) * 3
        if key[1] == 0:  # once for each pair: what the baselines alone make
            x, y = np.triu_indices(len(base), 1)
            a, b = np.concatenate([a, x]), np.concatenate([b, y])
            value = np.concatenate([value, int(bases["v"].iloc[0]) * np.abs(base[x] - base[y])])
        return pd.DataFrame({"lang": key[0], "a": a, "b": b, "value": value})

    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    postings = shares.select("lang", block, "term", "g", "p")
    bases = groups.select(F.col("lang").alias("of"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("g").alias("peer"), "base", "v")
    met = postings.groupBy("lang", "block").cogroup(bases.groupBy("of", "block")).applyInPandas(scatter, "lang string, a int, b int, value long")
    apart = met.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    one, other = (groups.select("lang", F.col("g").alias(k), F.col("source").alias(n)) for k, n in (("a", "one"), ("b", "other")))
    apart = apart.join(one, ["lang", "a"]).join(other, ["lang", "b"])
    both = F.explode(F.array(F.struct(F.col("one").alias("source"), F.col("other").alias("item")), F.struct(F.col("other").alias("source"), F.col("one").alias("item"))))
    pairs = apart.select("lang", both.alias("x"), "value").select("lang", "x.source", "x.item", "value").withColumn("rank", F.row_number().over(in_group))
    columns = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return columns(pairs, "pair").unionByName(columns(ahead, "term"))
