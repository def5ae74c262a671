"""Near copies by exact Jaccard similarity of word shingles.

Two documents link if the sets of their five-word shingles have a Jaccard similarity of 0.8 or more; no such pair is
left out. Candidates come from SimHash first: texts whose fingerprints differ in two bits at most, found by the Golay keys
of ``simhash``. Fingerprints of similar texts mostly differ in more bits, so prefixes of the sets give the other
candidates, and every candidate is verified by the whole sets. For that, each set is put in one order that all sets share: frequent shingles of a sample last, otherwise by hash. If two
sets of that similarity have n and m members, they share one among the first n - ceil(0.8 n) + 1 and m - ceil(0.8 m) + 1
of this order, so only these are keys. Pairs that share a key are first compared by bitmaps, whose bits are the parities
of the members' counts by hash: two sets differ in at least as many members as their bitmaps in bits, so a pair whose
bitmaps differ in more than similar sets can is dropped. The others are verified by the intersection of the whole sets.
The sample changes how many pairs are compared, never which are found.

Keys of more than ``bucket`` sets are not paired up at first: each member is verified with the likely middle one. Members
not yet in the component of most members of the key are then verified with ``HUBS`` likely middle ones of it, and those
still apart with all members of other components. Pairs in one component need no check, so the components are those of
all pairs. Of a pair that shares a key only those are compared whose sets are long enough from the key on: all that a
pair shares stands at or after the first key that it shares.

Shingles are compared by their 64-bit hashes. Nulls: a null text has no shingles; all texts without words are one set.
Rows with a null id all stay. Repeated ids may have different texts, and each row is judged by its own. Other columns of
the input are kept. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialise, small_batches, text_or_empty
from .simhash import components, fingerprint_of, hashed, links, one_of_each, shingles

#: The least similarity as a fraction, and the frequent shingles that are put last: of one in SAMPLE texts, at most FREQUENT.
SHARE = (4, 5)
SAMPLE, FREQUENT = 16, 20_000
SALTS = 16
HUBS = 8


def shingle_set(text: str, words: int = 5) -> np.ndarray:
    """The sorted hashes of a text's different shingles."""
    found = set(shingles(text, words))
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, found, repeat(42)), np.uint64, len(found)).view(np.int64))


def keys(found: np.ndarray, frequent: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The first members of a set in the shared order, as many as two similar sets can't both lack."""
    if not len(found):
        return found
    rank = np.zeros(len(found), np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
        rank = np.where(frequent[at] == found, ranks[at], 0)
    least = -(-len(found) * SHARE[0] // SHARE[1])
    return found[np.lexsort((found, rank))][: len(found) - least + 1]


def bitmap(found: np.ndarray) -> np.ndarray:
    """For each value of a hash whether an odd number of members has it, as longs: 2 to 4 bits a member, a power of two.

    The halves of a bitmap by exclusive or are the bitmap of half the size.
    """
    bits = max(64, 1 << (2 * len(found) - 1).bit_length()) if len(found) else 64
    odd = np.bincount(((found.view(np.uint64) >> np.uint64(20)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _halved(bits: Column) -> Column:
    half = (F.size(bits) / 2).cast("int")
    return F.zip_with(F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseXOR(y))


def _differing(a: Column, b: Column) -> Column:
    """In how many bits two bitmaps differ; of two sizes, the larger is halved once, which is enough for similar sets."""
    a, b = F.when(F.size(a) > F.size(b), _halved(a)).otherwise(a), F.when(F.size(b) > F.size(a), _halved(b)).otherwise(b)
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)


def _sets(text: Column, words: int) -> Column:
    @F.pandas_udf("array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shingle_set(t, words) for t in texts], dtype=object)

    return run(text)


def _frequent(docs: DataFrame, words: int, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles of a sample, sorted, and the rank of each by how frequent it is."""
    text = text_or_empty(text_col)
    some = docs.select(text.alias("t")).filter(F.pmod(F.xxhash64("t"), F.lit(SAMPLE)) == 0).distinct()
    counts = some.select(F.explode(_sets(F.col("t"), words)).alias("s")).groupBy("s").count().filter("count > 2")
    rows = counts.orderBy(F.col("count").desc(), "s").limit(FREQUENT).collect()
    found = np.array([r["s"] for r in rows], np.int64)
    order = np.argsort(found)
    return found[order], np.array([r["count"] for r in rows], np.int64)[order]


def _nodes(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, whole, node, n, keys, bits, fp) of every row; whole and node are digests of the text and its set, n the set's size."""
    frequent, ranks = _frequent(docs, words, text_col)

    @F.pandas_udf("node long, n int, keys array<long>, bits array<long>, fp long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            known: dict[str, tuple] = {}
            for t in texts:
                if t not in known:
                    hashes = hashed(t, words)
                    found = np.unique(hashes.view(np.int64))
                    fp = int(np.uint64(fingerprint_of(hashes)).view(np.int64))
                    known[t] = (_digest(found), len(found), keys(found, frequent, ranks), bitmap(found), fp)
            yield pd.DataFrame([known[t] for t in texts], columns=["node", "n", "keys", "bits", "fp"])

    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("whole"), run(text).alias("x")).select("doc_id", "whole", "x.*")


def _digest(found: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(found.tobytes())).view(np.int64))


def _attached(pairs: DataFrame, of: DataFrame, *columns: str) -> DataFrame:
    """pairs (a, b, salt) with columns of both nodes, as a_ and b_; a node in many pairs is dealt over SALTS keys."""
    left = pairs.join(of.select(F.col("node").alias("a"), *[F.col(c).alias(f"a_{c}") for c in columns]), "a")
    right = pairs.select("b", "salt").distinct().join(of.select(F.col("node").alias("b"), *[F.col(c).alias(f"b_{c}") for c in columns]), "b")
    return left.join(right, ["b", "salt"])


def _verified(pairs: DataFrame, firsts: DataFrame, docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets are similar."""

    @F.pandas_udf("node long, found array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            sets = [shingle_set(t, words) for t in texts]
            yield pd.DataFrame({"node": [_digest(s) for s in sets], "found": pd.Series(sets, dtype=object)})

    pairs = pairs.distinct().withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)))
    # of a_n + b_n = union + common, a similar pair's sets differ in (1 - share) / (1 + share) at most
    most = (F.col("a_n") + F.col("b_n")) * (SHARE[1] - SHARE[0])
    alike = (F.col("a_n") * SHARE[1] >= F.col("b_n") * SHARE[0]) & (F.col("b_n") * SHARE[1] >= F.col("a_n") * SHARE[0])
    pairs = _attached(pairs, firsts, "n", "bits").filter(alike)
    pairs = pairs.filter(_differing(F.col("a_bits"), F.col("b_bits")) * (SHARE[1] + SHARE[0]) <= most)
    pairs = materialise(pairs.select("a", "b", "salt"), "similar-pairs")
    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    # written, so that its size is known and texts needn't be shuffled for few ids
    ids = materialise(firsts.join(wanted, "node", "left_semi").select(F.col("first_id").alias("id"), "whole"), "similar-wanted")
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("t")).withColumn("whole", F.xxhash64("t"))
    texts = texts.join(ids, ["id", "whole"], "left_semi")
    sets = materialise(texts.select(run("t").alias("x")).select("x.*").dropDuplicates(["node"]), "similar-sets")
    both = _attached(pairs, sets, "found").withColumn("x", F.size(F.array_intersect("a_found", "b_found")))
    similar = F.col("x") * SHARE[1] >= (F.size("a_found") + F.size("b_found") - F.col("x")) * SHARE[0]
    return materialise(both.filter(similar).select("a", "b"), "similar-links")


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b) of nodes (node, fp): each with the first of its fingerprint, and the firsts of fingerprints within two bits.

    Where many fingerprints share a key, it is the links that ``links`` keeps: they have the components of all.
    """
    of = materialise(nodes.select("node", "fp").distinct(), "similar-fingerprints")
    heads = of.groupBy("fp").agg(F.min("node").alias("head"), F.count("*").alias("n"))
    same = of.join(heads.filter("n > 1"), "fp").select(F.col("head").alias("x"), F.col("node").alias("y"))
    near = links(of).join(heads.select(F.col("fp").alias("a"), F.col("head").alias("x")), "a").join(heads.select(F.col("fp").alias("b"), F.col("head").alias("y")), "b")
    pairs = same.unionByName(near.select("x", "y")).filter("x <> y")
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _starred(members: DataFrame, among: DataFrame, n: int) -> DataFrame:
    """(a, b): each member of a key with the n of the others that are most likely in its middle."""
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.col("middle").desc(), "node"))
    hubs = among.select("key", "node", "middle").withColumn("place", place).filter(F.col("place") <= n)  # cut before the shuffle
    hubs = hubs.groupBy("key").agg(F.collect_list("node").alias("hubs"))
    pairs = members.join(hubs, "key").select("node", F.explode("hubs").alias("hub")).filter("node <> hub")
    return pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))


def _rooted(docs: DataFrame, words: int, id_col: str, text_col: str, bucket: int) -> tuple[DataFrame, DataFrame]:
    """The nodes of every row, and (node, first_id, root) of every node: rows of one component have one root."""
    small_batches(docs.sparkSession)
    nodes = materialise(_nodes(docs, words, id_col, text_col), "similar")
    firsts = nodes.groupBy("node").agg(F.min(F.struct("doc_id", "whole")).alias("first"), F.first("n").alias("n"), F.first("bits").alias("bits"))
    firsts = materialise(firsts.select(F.col("first.doc_id").alias("first_id"), F.col("first.whole").alias("whole"), "node", "n", "bits"), "similar-nodes")
    one = firsts.select(F.col("first_id").alias("doc_id"), "whole", "node")
    of_key = Window.partitionBy("key")
    own = nodes.join(one, ["doc_id", "whole", "node"], "left_semi").select("node", "n", F.posexplode("keys").alias("place", "key"))
    keyed = own.dropDuplicates(["node", "key"])  # rows that repeat id and text
    keyed = keyed.withColumn("m", F.count("*").over(of_key)).filter("m > 1")
    shared = materialise(keyed.withColumn("rest", F.col("n") - F.col("place")).drop("place"), "similar-shared")
    # similar sets share (n + n) * share / (1 + share) at least, and at most what either has from its first shared key on
    near = F.least("x.rest", "y.rest") * (SHARE[0] + SHARE[1]) >= (F.col("x.n") + F.col("y.n")) * SHARE[0]
    few, many = shared.filter(F.col("m") <= bucket), shared.filter(F.col("m") > bucket).drop("m")
    # a set with many such keys has few shingles of its own, so it is near to most of its group: a hub
    many = materialise(many.join(many.groupBy("node").agg(F.count("*").alias("middle")), "node"), "similar-many")
    paired = few.alias("x").join(few.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.node") < F.col("y.node")) & near)
    paired = paired.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))
    # written apart: one plan of all candidates and their verification has stages by the dozen, which the driver holds at once
    near_pairs = materialise(fingerprint_pairs(nodes), "similar-near")
    candidates = materialise(paired.unionByName(_starred(many, many, 1)).distinct(), "similar-candidates")
    roots = components(_verified(near_pairs.unionByName(candidates), firsts, docs, words, id_col, text_col))
    for all_pairs in (False, True):
        rooted = many.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        sizes = rooted.groupBy("key", "root").count().groupBy("key").agg(F.max_by("root", "count").alias("most"), F.count("*").alias("roots"))
        open_ = materialise(rooted.join(sizes.filter("roots > 1"), "key"), "similar-open")
        if open_.isEmpty():
            break
        apart = open_.filter("root <> most")
        if all_pairs:
            more = apart.alias("x").join(open_.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.root") != F.col("y.root")) & near)
            more = more.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
        else:
            more = _starred(apart, open_.filter("root = most"), HUBS)
        found = _verified(more, firsts, docs, words, id_col, text_col)
        if not found.isEmpty():
            roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(found))
    return nodes, firsts.select("node", "first_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def similar_components(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text", bucket: int = 2) -> DataFrame:
    """(doc_id, component_id) of every row: the smallest id that links of a similarity of 0.8 or more lead to."""
    nodes, rooted = _rooted(docs, words, id_col, text_col, bucket)
    of = rooted.join(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "root").select("node", "component_id")
    return nodes.select("doc_id", "node").join(of, "node").select("doc_id", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text", bucket: int = 2) -> DataFrame:
    """docs with one row of each component (``one_of_each``). Rows with a null id can't be told apart and all stay."""
    named = docs.filter(F.col(id_col).isNotNull())
    kept = one_of_each(named, *_rooted(named, words, id_col, text_col, bucket), "node", id_col, text_col)
    return kept.unionByName(docs.filter(F.col(id_col).isNull()))
