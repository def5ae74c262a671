"""Approximate nearest neighbours with a hash-prefix forest.

Vectors are dealt to shards. In each shard, every tree gives a vector a long hash string (the signs of random
projections of the centred vector) and keeps the strings in a sorted array. A query descends each array to its longest
matching prefix; then all trees ascend together, one bit at a time, so that entries that share ever shorter prefixes
join, until enough candidates are found. Their exact distances decide, and shards' best are merged.

``share`` says how many entries a query looks at, as a part of its shard (counted over all trees). Neighbours in these
vectors are not much nearer than the rest, so a recall of 0.9 takes a large share; see the README for measured recall.

Vectors of different lengths are searched apart from each other. Zero vectors take no part, nor do those that
``_vectors`` leaves out. Ties go to smaller ids. Fewer candidates than k give all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _vectors

BITS = 64


class Forest:
    """One shard's vectors in sorted arrays of hash strings, one array for each tree."""

    def __init__(self, vectors: np.ndarray, trees: int, seed: int = 7) -> None:
        self.vectors, self.center = vectors, vectors.mean(axis=0)
        rnd = np.random.default_rng(seed)
        self.planes = rnd.standard_normal((trees, vectors.shape[1], BITS))
        self.order, self.strings = [], []
        for tree in range(trees):
            s = self.hashes(vectors, tree)
            self.order.append(np.argsort(s, kind="stable"))
            self.strings.append(s[self.order[-1]])

    def hashes(self, vectors: np.ndarray, tree: int) -> np.ndarray:
        signs = (vectors - self.center) @ self.planes[tree] > 0
        return np.packbits(signs, axis=1).view(">u8").astype(np.uint64).ravel()

    def candidates(self, queries: np.ndarray, enough: int) -> Iterator[np.ndarray]:
        """For each query the indices of its candidates."""
        trees = len(self.order)
        own = [self.hashes(queries, t) for t in range(trees)]
        low, high = np.zeros((trees, len(queries)), np.int64), np.full((trees, len(queries)), len(self.vectors))
        open_ = np.arange(len(queries))
        for length in range(BITS, 0, -1):
            rest = np.uint64((1 << (BITS - length)) - 1)
            a = np.array([np.searchsorted(self.strings[t], own[t][open_] & ~rest, "left") for t in range(trees)])
            b = np.array([np.searchsorted(self.strings[t], own[t][open_] | rest, "right") for t in range(trees)])
            full = (b - a).sum(axis=0) >= enough
            low[:, open_[full]], high[:, open_[full]] = a[:, full], b[:, full]
            open_ = open_[~full]
            if not len(open_):
                break
        for q in range(len(queries)):
            met = np.zeros(len(self.vectors), bool)
            for t in range(trees):
                met[self.order[t][low[t, q] : high[t, q]]] = True
            yield np.flatnonzero(met)


def search_cell(k: int, ids: np.ndarray, forest: Forest, names: np.ndarray, queries: np.ndarray, floors: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, distance) of the nearest k found in a shard for each query of a block, none farther than its floor."""
    # so many over all trees are more than k different ones
    enough = max(len(forest.order) * (k + 1), int(share * len(forest.vectors)))
    out = []
    for q, at in enumerate(forest.candidates(queries, enough)):
        distance = np.sqrt(((forest.vectors[at] - queries[q]) ** 2).sum(axis=1))
        kept = (ids[at] != names[q]) & ~(distance > floors[q])
        at, distance = ids[at[kept]], distance[kept]
        found = _vectors.best(np.zeros(len(at), np.int64), at, distance, k)
        out.append((np.full(len(found), q), at[found], distance[found]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, trees: int = 16, share: float = 0.8, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row, other rows than itself.

    vectors are what is searched; queries are rows of the same columns. A query doesn't find rows of its own id.
    """
    made: list[tuple[bytes, Forest]] = []  # a task's cells come shard by shard

    def cell(k: int, ids: np.ndarray, rows: np.ndarray, names: np.ndarray, asked: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not made or made[0][0] != ids.tobytes() or made[0][1].vectors.shape != rows.shape:
            made[:] = [(ids.tobytes(), Forest(rows, trees))]
        return search_cell(k, ids, made[0][1], names, asked, floors, share)

    nonzero = F.exists("v", lambda x: x != 0)
    entries = _vectors.shards(_vectors.usable(vectors, id_col, vector_col).filter(nonzero), "forest-shards")
    asked = _vectors.usable(queries, id_col, vector_col).filter(nonzero)
    return _vectors.rounds(entries, asked, k, cell, "double", F.col("score"), worst=F.max)
