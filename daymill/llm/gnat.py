"""Hard negatives with a multiway hyperplane tree in the manner of GNAT.

Every component x counts as floor(scale * x), and a row's score for an anchor is the integer inner product. With one more
component that brings all rows to the norm of the longest, a score is a distance: d**2 = |anchor|**2 + M**2 - 2 score. So
the rows of a window of scores lie in an annulus around the anchor, and the best scores are the nearest rows.

A node deals its rows to the nearest of its split points. Each split point stores, for every sibling's subtree, the least
and the largest distance to the rows in it. A subtree is eliminated if for some split point its range, seen from the
anchor's distance to that point, can't meet the annulus. What is left ends in leaves, where integer scores decide.

The root is one for all rows: split points from a bounded sample, exact ranges over all rows. Its subtrees are cells; a
cell's rows are dealt into shards of about ``SHARD_BYTES``, each with a tree of its own, made by the task that searches
it. An anchor goes first to one shard of its own cell, which gives it a floor, and then to the cells that the root's
ranges leave for what is above the floor. First the anchors' positives are searched, then for each of them the negatives.

The root's sample and ranges: for at most ``LENGTHS`` lengths of vectors, the commonest, at most ``SAMPLE`` rows and
``CELLS`` split points each, within ``PIVOT_BYTES``; this reaches the driver and goes out with the tasks. Rows of other
lengths are one cell. Vectors of different lengths don't meet.

Rows with a null id, label or vector, or with a null or non-finite component, take no part; zero and empty vectors do.
Rows that repeat id, label and vector count once. Rows that share an id but not the rest are one item, scored by the
best of them that has the label asked for and fits the window, and each is an anchor of its own; an anchor meets no row
of its own id.
Scores beyond 2**53 are computed with Python's integers and without a tree, and beyond a long they are cut to its range.
Ties go to smaller ids; fewer rows than asked give all of them; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import _vectors
from ._common import materialise, small_batches
from .maxscore import LONG, _integers, _narrowest, scaled

LENGTHS, SAMPLE, CELLS, PIVOT_BYTES = 64, 512, 128, 1 << 20
SHARD_BYTES = 1 << 20
BLOCK_ROWS = 512
FANOUT, LEAF = 12, 48
#: What rounding may do to a distance, as a part of the largest norm.
SLACK = 1e-6

_ASKED = "anchor_id long, akey long, positive_id long, label long, n int, v array<double>, low long, high long, floor long"


def spread(sample: np.ndarray, most: int) -> np.ndarray:
    """Which rows of a sample are split points: each the farthest from those before; fewer if rows are the same."""
    chosen = [0]
    near = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < most and near.max(initial=0) > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return np.array(chosen)


def lifted(rows: np.ndarray, most: float) -> np.ndarray:
    """rows with the component that brings them to the squared norm ``most``."""
    return np.hstack([rows, np.sqrt(np.maximum(most - (rows**2).sum(axis=1), 0))[:, None]])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * a @ b.T, 0))


def met(to_points: np.ndarray, low: np.ndarray, high: np.ndarray, nearest: np.ndarray, farthest: np.ndarray, slack: float) -> np.ndarray:
    """(queries, subtrees): whether a subtree can hold rows between a query's nearest and farthest distance.

    to_points: the queries' distances to the split points; low, high: by split point and subtree.
    """
    d = to_points[:, :, None]
    least = np.maximum(d - high, low - d).max(axis=1)
    largest = (d + high).min(axis=1)
    return (least <= farthest[:, None] + slack) & (largest >= nearest[:, None] - slack)


class Tree:
    """One shard's rows; rows are lifted, and leaves are arrays of row numbers."""

    def __init__(self, rows: np.ndarray, most: float) -> None:
        self.rows, self.slack = lifted(rows, most), SLACK * max(np.sqrt(most), 1)
        self.root = self._grown(np.arange(len(rows)))

    def _grown(self, mine: np.ndarray):
        if len(mine) <= LEAF:
            return mine
        rows = self.rows[mine]
        points = rows[spread(rows[:: max(1, len(mine) // (8 * FANOUT))], FANOUT)]
        d = distances(points, rows)
        of = d.argmin(axis=0)
        if len(points) < 2 or np.bincount(of).max() == len(mine):
            return mine  # rows that can't be told apart
        subtrees = [np.flatnonzero(of == j) for j in range(len(points))]
        subtrees = [x for x in subtrees if len(x)]
        low, high = (np.stack([f(d[:, x], axis=1) for x in subtrees], axis=1) for f in (np.min, np.max))
        return points, low, high, [self._grown(mine[x]) for x in subtrees]

    def leaves(self, queries: np.ndarray, nearest: np.ndarray, farthest: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(row numbers, query numbers) of each leaf and the queries whose annulus can meet it."""
        lifted_ = np.hstack([queries, np.zeros((len(queries), 1))])
        slack = self.slack + SLACK * np.sqrt((queries**2).sum(axis=1).max(initial=0))
        open_ = [(self.root, np.arange(len(queries)))]
        while open_:
            node, asked = open_.pop()
            if isinstance(node, np.ndarray):
                yield node, asked
                continue
            points, low, high, children = node
            kept = met(distances(lifted_[asked], points), low, high, nearest[asked], farthest[asked], slack)
            open_ += [(child, asked[kept[:, j]]) for j, child in enumerate(children) if kept[:, j].any()]


def annulus(queries: np.ndarray, low: np.ndarray, high: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """The distances between which the rows of these scores lie; infinite bounds are none."""
    norm = (queries**2).sum(axis=1) + most
    return np.sqrt(np.maximum(norm - 2 * high, 0)), np.sqrt(np.maximum(norm - 2 * low, 0))


def search_shard(tree: Tree | None, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, asked: pd.DataFrame, queries: np.ndarray, k: int, same: bool, most: float) -> tuple[np.ndarray, ...]:
    """(query number, id, score): each query's best k rows of a shard with the label (or another one) within its window."""
    own, of_label = asked["anchor_id"].to_numpy(), asked["label"].to_numpy()
    low = np.fmax(asked["low"].to_numpy(np.float64), asked["floor"].to_numpy(np.float64))
    low, high = np.where(np.isnan(low), -np.inf, low), asked["high"].to_numpy(np.float64)
    high = np.where(np.isnan(high), np.inf, high)
    found = []

    def keep(at: np.ndarray, of: np.ndarray, score: np.ndarray) -> None:
        fits = (labels[at][:, None] == of_label[of]) == same
        i, j = np.nonzero(fits & (ids[at][:, None] != own[of]) & (score >= low[of]) & (score <= high[of]))
        found.append((of[j], at[i], score[i, j].astype(np.int64)))

    if tree is None:
        score = np.array([max(min(s, LONG), -LONG - 1) for s in (_integers(rows, object) @ _integers(queries, object).T).ravel().tolist()], np.int64).reshape(len(rows), len(queries))
        low, high = (np.array([fallback if np.isnan(x) else int(x) for x in asked[c].to_numpy(np.float64)], object) for c, fallback in (("low", -LONG - 1), ("high", LONG)))
        keep(np.arange(len(rows)), np.arange(len(queries)), score)
    else:
        for at, of in tree.leaves(queries, *annulus(queries, low, high, most)):
            keep(at, of, rows[at] @ queries[of].T)
    of, at, score = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
    best = _vectors.best(of, ids[at], ~score, k)
    return of[best], ids[at][best], score[best]


class Root:
    """The split points of each length with the ranges of all cells; ranges are known once the rows are dealt."""

    def __init__(self, rows: DataFrame, scale: int) -> None:
        squared = F.aggregate("v", F.lit(0.0), lambda a, x: a + F.pow(F.floor(scale * x).cast("double"), F.lit(2.0)))
        whole = F.when(F.forall("v", lambda x: F.abs(x) < 2.0**40), squared).otherwise(float("inf"))
        sizes = rows.groupBy("n").agg(F.count("*").alias("rows"), F.max(whole).alias("most"))
        sizes = {r["n"]: (r["rows"], r["most"]) for r in sizes.orderBy(F.col("rows").desc(), "n").limit(LENGTHS).collect()}
        self.scale, self.most, self.points, self.ranges = scale, {n: m for n, (_, m) in sizes.items()}, {}, {}
        by_hash = Window.partitionBy("n").orderBy(F.xxhash64("vec_id", "v"), "vec_id")
        few = F.least(F.lit(SAMPLE), F.greatest(F.lit(1), F.lit(PIVOT_BYTES) / (8 * F.greatest(F.col("n"), F.lit(1)))))
        sample = rows.filter(F.col("n").isin([*sizes])).select("vec_id", "n", "v").withColumn("i", F.row_number().over(by_hash)).filter(F.col("i") <= SAMPLE).filter(F.col("i") <= few)
        of: dict[int, list] = {}
        for r in sample.orderBy("n", "i").select("n", "v").toLocalIterator():
            of.setdefault(r["n"], []).append(r["v"])
        for n, vectors in of.items():
            count, most = sizes[n]
            if np.isfinite(most):
                x = lifted(scaled(np.array(vectors, np.float64).reshape(len(vectors), n), scale), most)
                self.points[n] = x[spread(x, min(CELLS, -(-count * 8 * max(n, 1) // SHARD_BYTES)))]

    def distances(self, n: int, rows: np.ndarray, anchors: bool) -> np.ndarray | None:
        """The distances of rows, or of anchors, to the split points of their length; None if it has none."""
        if n not in self.points:
            return None
        x = scaled(rows, self.scale)
        return distances(np.hstack([x, np.zeros((len(x), 1))]) if anchors else lifted(x, self.most[n]), self.points[n])


def shards(rows: DataFrame, root: Root) -> DataFrame:
    """(n, cell, part, ids, labels, m, low, high): rows in packed shards, with their distances from the split points."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for n, mine in x.groupby("n", sort=False):
                d = root.distances(int(n), _vectors.matrix(mine["v"]), False)
                yield mine.assign(cell=0 if d is None else d.argmin(axis=1))

    def pack(mine: pd.DataFrame) -> pd.DataFrame:
        m = _vectors.matrix(mine["v"])
        d = root.distances(int(mine["n"].iloc[0]), m, False)
        d = np.zeros((len(mine), 0)) if d is None else d
        packed = {k: [mine[c].to_numpy(np.int64).tobytes()] for k, c in (("ids", "vec_id"), ("labels", "label"))}
        return pd.DataFrame({c: mine[c].iloc[:1] for c in ("n", "cell", "part")} | packed | {"m": [m.tobytes()], "low": [d.min(axis=0)], "high": [d.max(axis=0)]})

    small_batches(rows.sparkSession)
    dealt = materialise(rows.mapInPandas(deal, "vec_id long, label long, v array<double>, n int, cell int"), "gnat-rows")
    size = F.greatest(F.lit(1), F.lit(SHARD_BYTES) / (8 * F.greatest(F.col("n"), F.lit(1))))
    # one row for each length and cell
    counts = dealt.groupBy("n", "cell").agg(F.ceil(F.count("*") / F.max(size)).cast("int").alias("parts"))
    dealt = dealt.join(counts, ["n", "cell"]).withColumn("part", F.pmod(F.xxhash64("vec_id", "label", "v"), F.col("parts")).cast("int"))
    packed = dealt.groupBy("n", "cell", "part").applyInPandas(pack, "n int, cell int, part int, ids binary, labels binary, m binary, low array<double>, high array<double>")
    return materialise(packed, "gnat-shards")


def _ranges(entries: DataFrame, root: Root) -> None:
    """Give the root the ranges of its cells: at most LENGTHS x CELLS x CELLS rows come to the driver."""
    each = entries.filter(F.size("low") > 0).select("n", "cell", F.posexplode(F.arrays_zip("low", "high")).alias("point", "d"))
    for r in each.groupBy("n", "cell", "point").agg(F.min("d.low").alias("low"), F.max("d.high").alias("high")).toLocalIterator():
        if r["n"] not in root.ranges:
            k = len(root.points[r["n"]])
            root.ranges[r["n"]] = (np.full((k, k), np.inf), np.full((k, k), -np.inf))  # cells without rows are met by none
        low, high = root.ranges[r["n"]]
        low[r["point"], r["cell"]], high[r["point"], r["cell"]] = r["low"], r["high"]


def _met(entries: DataFrame, asked: DataFrame, root: Root, k: int, same: bool, first: bool) -> DataFrame:
    """(anchor_id, akey, positive_id, vec_id, score): what one shard of the own cell gives, or what all others do."""

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for n, mine in x.groupby("n", sort=False):
                n, v = int(n), _vectors.matrix(mine["v"])
                d = root.distances(n, v, True)
                if d is None:
                    yield mine.assign(cell=0, own=True)
                    continue
                low_of, high_of = root.ranges[n]
                queries, slack = scaled(v, root.scale), SLACK * max(np.sqrt(root.most[n]), 1)
                own = np.where(np.isfinite(low_of[0]), d, np.inf).argmin(axis=1)
                if first:
                    yield mine.assign(cell=own, own=True)
                    continue
                low = np.fmax(mine["low"].to_numpy(np.float64), mine["floor"].to_numpy(np.float64))
                high = mine["high"].to_numpy(np.float64)
                bounds = annulus(queries, np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high), root.most[n])
                i, j = np.nonzero(met(d, low_of, high_of, *bounds, slack + SLACK * np.sqrt((queries**2).sum(axis=1).max(initial=0))))
                yield mine.iloc[i].assign(cell=j, own=own[i] == j)

    def pack(mine: pd.DataFrame) -> pd.DataFrame:
        named = mine.drop(columns=["v", "n", "cell", "own", "block"])
        missing = {f"no_{c}": [named[c].isna().to_numpy().tobytes()] for c in ("low", "high", "floor")}
        packed = {f"q_{c}": [named[c].fillna(0).to_numpy(np.int64).tobytes()] for c in named.columns}
        return pd.DataFrame({c: mine[c].iloc[:1] for c in ("n", "cell", "own")} | packed | missing | {"q": [_vectors.matrix(mine["v"]).tobytes()]})

    def answer(cells: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made: list[tuple] = []  # a task's cells come shard by shard
        for cell in cells:
            for x in cell.itertuples(index=False):
                rows, queries = (scaled(np.frombuffer(b, np.float64).reshape(len(i) // 8, x.n), root.scale) for b, i in ((x.m, x.ids), (x.q, x.q_akey)))
                ids, labels = np.frombuffer(x.ids, np.int64), np.frombuffer(x.labels, np.int64)
                asked_ = pd.DataFrame({c: np.frombuffer(getattr(x, f"q_{c}"), np.int64) for c in ("anchor_id", "akey", "positive_id", "label", "low", "high", "floor")})
                exact = _narrowest(rows, queries) is not object
                for c in ("low", "high", "floor"):
                    asked_[c] = asked_[c].astype(np.float64 if exact else object).mask(np.frombuffer(getattr(x, f"no_{c}"), bool))
                tree, most = None, root.most.get(x.n, np.inf)
                if exact:
                    most = most if np.isfinite(most) else float((rows**2).sum(axis=1).max(initial=0))
                    if not made or made[0] != (x.n, x.ids, x.m):
                        made[:] = [(x.n, x.ids, x.m), Tree(rows, most)]
                    tree = made[1]
                of, at, score = search_shard(tree, rows, ids, labels, asked_, queries, k, same, most)
                yield asked_.iloc[of][["anchor_id", "akey", "positive_id"]].assign(vec_id=at, score=score)

    parts = entries.groupBy("n", "cell").agg(F.max("part").alias("last"))  # one row for each length and cell
    routed = asked.mapInPandas(route, f"{_ASKED}, cell int, own boolean")
    blocks = F.greatest(F.lit(1), F.lit(asked.count() // BLOCK_ROWS)).cast("int")
    routed = routed.withColumn("block", F.pmod(F.xxhash64("anchor_id", "akey", "positive_id"), blocks))
    longs = ", ".join(f"q_{c} binary" for c in ("anchor_id", "akey", "positive_id", "label", "low", "high", "floor"))
    packed = routed.groupBy("n", "cell", "own", "block").applyInPandas(pack, f"n int, cell int, own boolean, {longs}, no_low binary, no_high binary, no_floor binary, q binary")
    if first:
        wide = packed.withColumn("part", F.lit(0))
    else:
        from_ = F.when(F.col("own"), F.lit(1)).otherwise(F.lit(0))
        wide = packed.join(parts, ["n", "cell"]).filter(F.col("last") >= from_).withColumn("part", F.explode(F.sequence(from_, F.col("last"))))
    cells = entries.drop("low", "high").join(wide.hint("merge"), ["n", "cell", "part"]).drop("cell", "part", "own")
    return cells.mapInPandas(answer, "anchor_id long, akey long, positive_id long, vec_id long, score long")


def _best(entries: DataFrame, asked: DataFrame, root: Root, k: int, same: bool, name: str) -> DataFrame:
    """(anchor_id, akey, positive_id, rank, vec_id, score): the best k over all shards, in two rounds."""
    keys = ["anchor_id", "akey", "positive_id"]
    early = materialise(_met(entries, asked, root, k, same, True), f"{name}-early")
    floors = early.groupBy(*keys).agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    later = materialise(asked.drop("floor").join(floors, keys, "left").select(*asked.columns), f"{name}-asked")
    once = _met(entries, later, root, k, same, False).unionByName(early).groupBy(*keys, "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), "vec_id"))).filter(F.col("rank") <= k)
    return materialise(ranked.select(*keys, "rank", "vec_id", "score"), name)


def mine(
    rows: DataFrame, anchors: Column | None = None, positives: int = 5, negatives: int = 10, window: tuple[int, int] = (30, 90), scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each anchor and positive.

    An anchor's positives are the best ``positives`` other rows of its label. Their negatives are the best ``negatives``
    rows of other labels whose score is within ``window``, in hundredths of the positive's score (none for a negative
    score). anchors: a condition on vec_id, label and v (the vector); all rows by default.
    """
    vector = F.col(vector_col).cast("array<double>")
    sound = F.forall("v", lambda x: F.coalesce(x > float("-inf"), F.lit(False)) & (x < float("inf")))
    named = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), vector.alias("v"))
    named = named.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & sound).distinct().withColumn("n", F.size("v"))
    named = materialise(named, "gnat-input")
    root = Root(named, scale)
    entries = shards(named, root)
    _ranges(entries, root)
    none = F.lit(None).cast("long")
    asking = named.filter(F.lit(True) if anchors is None else anchors).withColumn("akey", F.xxhash64("vec_id", "label", "v"))
    asked = asking.select(F.col("vec_id").alias("anchor_id"), "akey", F.lit(0).cast("long").alias("positive_id"), "label", "n", "v", none.alias("low"), none.alias("high"), none.alias("floor"))
    asked = materialise(asked, "gnat-anchors")
    near = _best(entries, asked, root, positives, True, "gnat-positives")
    near = near.select("anchor_id", "akey", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    score = F.col("positive_score").cast("decimal(38,0)")
    bounds = [F.call_function("div", score * F.lit(w) + F.lit(up), F.lit(100).cast("decimal(38,0)")).cast("long").alias(c) for w, up, c in ((window[0], 99, "low"), (window[1], 0, "high"))]
    windows = near.filter("positive_score >= 0").join(asked.drop("positive_id", "low", "high"), ["anchor_id", "akey"])
    windows = materialise(windows.select("anchor_id", "akey", "positive_id", "label", "n", "v", *bounds, "floor"), "gnat-windows")
    hard = _best(entries, windows, root, negatives, False, "gnat-negatives")
    out = hard.select("anchor_id", "akey", "positive_id", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")).join(near, ["anchor_id", "akey", "positive_id"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
