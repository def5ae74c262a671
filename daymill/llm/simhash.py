"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint falls into segments of 23, 23 and 18 bits. The perfect binary Golay code puts every 23-bit word
within three bits of one codeword; the indices of all codewords within four bits of a segment (one or six) are its
keys, and two segments that differ in one bit at most always share a key. Two errors over three segments leave, for
some segment i, no error in i and at most one in the segment after it; so fingerprints that differ in at most two
bits share a key (i, bits of segment i, codeword index of the next segment). Equal keys are joined and verified.

Keys that more than ``bucket`` different fingerprints share are not paired up. Their members are linked exactly by
midpoints instead: two fingerprints that differ in at most two bits lie within one bit of a common word, and all
that lie within one bit of the same word are linked, so each is linked to the smallest of them.

Nulls: a null text has no words (fingerprint zero). Repeated rows and repeated ids stay, each with its own
fingerprint. An empty table gives an empty result. Other columns of the input are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import materialise, small_batches, text_or_empty

#: The generator polynomial of the binary Golay code, and the segments' first bits and lengths.
GOLAY = 0b110001110101
SEGMENTS = ((0, 23), (23, 23), (46, 18))


def shingles(text: str, words: int) -> list[bytes]:
    """The runs of so many words of a text, A-Z lower-cased; the whole sequence if it is shorter."""
    w = text.encode("utf-8", "surrogatepass").lower().split()
    if len(w) <= words:
        return [b" ".join(w)] if w else []
    return list(map(b" ".join, zip(*(w[i:] for i in range(words)), strict=False)))


def fingerprint(text: str, words: int = 3) -> int:
    """The SimHash of a text as an unsigned number; a bit is 1 if set in over half the shingles' hashes."""
    return fingerprint_of(hashed(text, words))


def hashed(text: str, words: int) -> np.ndarray:
    """The hashes of a text's shingles, repeats included."""
    found = shingles(text, words)
    return np.fromiter(map(xxhash.xxh64_intdigest, found, repeat(42)), np.uint64, len(found))


def fingerprint_of(hashes: np.ndarray) -> int:
    """The SimHash of so many hashes; zero of none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        ones += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, whole, fp) of every row: the text's digest, and the fingerprint as a signed long."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def fps(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            known: dict[str, int] = {}
            for t in texts:
                if t not in known:
                    known[t] = fingerprint(t, words)
            yield pd.Series(np.array([known[t] for t in texts], np.uint64).view(np.int64))

    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("whole"), fps(text).alias("fp"))


def _patterns() -> np.ndarray:
    """For each syndrome the error patterns of up to four bits that have it; a row repeats its first to the end."""
    rest = [0] * 23
    for i in range(23):
        x = 1 << i
        for k in range(22, 10, -1):
            if x >> k & 1:
                x ^= GOLAY << (k - 11)
        rest[i] = x
    found: list[list[int]] = [[] for _ in range(2048)]

    def grow(first: int, error: int, syndrome: int, weight: int) -> None:
        if weight < 4 or len(found[syndrome]) < 6:
            found[syndrome].append(error)
        if weight < 4:
            for i in range(first, 23):
                grow(i + 1, error | 1 << i, syndrome ^ rest[i], weight + 1)

    grow(0, 0, 0, 0)
    return np.array([x + x[:1] * (6 - len(x)) for x in found], np.int64)


class GolayKeys:
    """The keys of fingerprints, vectorised."""

    def __init__(self) -> None:
        self.patterns = _patterns()
        rest = np.zeros(1 << 23, np.int16)
        for i in range(23):
            x = 1 << i
            for k in range(22, 10, -1):
                if x >> k & 1:
                    x ^= GOLAY << (k - 11)
            rest[1 << i : 1 << (i + 1)] = rest[: 1 << i] ^ np.int16(x)
        self.syndrome = rest

    def near(self, segment: np.ndarray) -> np.ndarray:
        """Six codeword indices for each segment, with repeats where there is only one."""
        return (segment[:, None] ^ self.patterns[self.syndrome[segment]]) >> 11

    def keys(self, fp: np.ndarray) -> np.ndarray:
        u = fp.astype(np.int64).view(np.uint64)
        parts = [((u >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
        rows = [(i << 40 | parts[i] << 12)[:, None] | self.near(parts[(i + 1) % 3]) for i in range(3)]
        return np.concatenate(rows, axis=1)


def _key_frame(fps: DataFrame) -> DataFrame:
    @F.pandas_udf("array<long>")
    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        golay = GolayKeys()
        for fp in batches:
            yield pd.Series([np.unique(k) for k in golay.keys(fp.to_numpy())], dtype=object)

    return fps.select("fp", F.explode(keys("fp")).alias("key"))


def links(fps: DataFrame, bucket: int = 64) -> DataFrame:
    """(a, b), a < b: links between different fingerprints that have the components of all pairs within two bits."""
    keyed = _key_frame(fps.select("fp").distinct())
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = materialise(keyed.join(sizes, "key"), "simhash-shared")
    near = F.expr(
        "flatten(transform(f, (x, i) -> transform(filter(slice(f, i + 2, size(f)), y -> bit_count(x ^ y) <= 2), y -> struct(x AS a, y AS b))))"
    )
    paired = (
        shared.filter(F.col("n") <= bucket)
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("fp")).alias("f"))
        .select(F.explode(near).alias("p"))
        .select("p.a", "p.b")
    )
    middles = (
        shared.filter(F.col("n") > bucket)
        .select("fp")
        .distinct()
        .select("fp", F.expr("explode(concat(array(fp), transform(sequence(0, 63), i -> fp ^ shiftleft(1L, i)))) AS mid"))
    )
    roots = middles.groupBy("mid").agg(F.min("fp").alias("root"), F.count("*").alias("n")).filter("n > 1")
    starred = middles.join(roots, "mid").filter("fp > root").select(F.col("root").alias("a"), F.col("fp").alias("b"))
    return paired.unionByName(starred).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether each node has one link at most to a smaller one, and none if larger ones link to it."""
    ends = edges.select(F.col("v").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.unionByName(edges.select(F.col("m").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    ends = ends.groupBy("node").agg((F.sum("up") + F.max("down")).alias("n"))
    return (ends.agg(F.max("n")).first()[0] or 0) <= 1


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each linked node can reach, by alternating large and small stars.

    edges: (a, b). Each round is a few joins and aggregates; the number of rounds grows with the logarithm of the
    longest chain, and links that are stars already take none. Nodes without a link are not returned.
    """
    edges = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("m")).distinct(), "links")
    for _ in range(rounds):
        if _settled(edges):
            return edges.select(F.col("v").alias("node"), F.col("m").alias("root"))
        both = edges.unionByName(edges.select(F.col("m").alias("v"), F.col("v").alias("m")))
        least = both.groupBy("v").agg(F.least(F.min("m"), F.col("v")).alias("r"))
        large = both.join(least, "v").filter("m > v").select(F.col("m").alias("v"), F.col("r").alias("m")).distinct()
        least = large.groupBy("v").agg(F.min("m").alias("r"))
        small = large.join(least, "v")
        small = small.filter("m <> r").select(F.col("m").alias("v"), F.col("r").alias("m")).unionByName(least.select("v", F.col("r").alias("m"))).distinct()
        edges = materialise(small, "stars")
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _rooted(docs: DataFrame, words: int, id_col: str, text_col: str, bucket: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, whole, fp) of every row, and (fp, first_id, root) of every fingerprint."""
    fps = materialise(fingerprints(docs, words, id_col, text_col), "simhash")
    firsts = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = components(links(firsts, bucket)).select(F.col("node").alias("fp"), "root")
    return fps, firsts.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, words: int = 3, id_col: str = "doc_id", text_col: str = "text", bucket: int = 64) -> DataFrame:
    """(doc_id, fp, component_id) of every row; fingerprints link at two or fewer differing bits."""
    fps, rooted = _rooted(docs, words, id_col, text_col, bucket)
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of = rooted.join(least, "root").select("fp", "component_id")
    return fps.join(of, "fp").select("doc_id", "fp", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, digests: DataFrame, rooted: DataFrame, node: str, id_col: str, text_col: str) -> DataFrame:
    """docs with one row of each component; digests: (doc_id, whole, node) of every row, rooted: (node, root).

    That row has the smallest id, and the smallest digest of its text if several texts have that id. If rows repeat both
    id and text, one of them stays. Aggregates alone, so a component that holds a third of all rows is no hot group.
    """
    first = digests.groupBy(node).agg(F.min(F.struct("doc_id", "whole")).alias("first"))
    keep = rooted.join(first, node).groupBy("root").agg(F.min("first").alias("first"))
    keep = keep.select(F.col("first.doc_id").alias("__mill_id"), F.col("first.whole").alias("__mill_whole"))
    rows = docs.withColumn("__mill_text", F.xxhash64(text_or_empty(text_col)))
    kept = rows.join(keep, (F.col(id_col) == F.col("__mill_id")) & (F.col("__mill_text") == F.col("__mill_whole")), "left_semi")
    return kept.dropDuplicates([id_col, "__mill_text"]).drop("__mill_text")


def keep_one(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text", bucket: int = 64) -> DataFrame:
    """docs with one row of each component (``one_of_each``). Rows with a null id can't be told apart and all stay."""
    named = docs.filter(F.col(id_col).isNotNull())
    kept = one_of_each(named, *_rooted(named, words, id_col, text_col, bucket), "fp", id_col, text_col)
    return kept.unionByName(docs.filter(F.col(id_col).isNull()))
