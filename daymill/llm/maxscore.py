"""Exact top-k search by integer inner product with MaxScore.

A term is a dimension with a sign; its postings are the entries whose component has that sign, with its size. A query
takes, for each of its dimensions, the postings that add to the score; components of the other sign take away, so
what the postings add is an upper bound. A query's terms are ordered by the most that they can add. The terms at the end
that together can't reach its k-th best score so far are non-essential: an entry that only they hold can't be found.
The postings of the essential terms are traversed, for all queries of a block at once; the entries that what is left
could still lift to the k-th best are probed, which gives their exact score. Shards are searched in rounds and merged;
each round starts from the k-th best of those before (``_vectors``).

Vectors null or with null or non-finite components take no part; vectors of different lengths are searched apart. An
empty vector's score is 0. Scores are exact: 32- or 64-bit floats where no sum can pass their exact integers, else
Python's integers. Scores beyond a long are cut to its range, and count as equal there. Ties go to smaller ids. Fewer
candidates than k give all of them; an empty table gives an empty result. Rows that share an id: see ``_vectors``.
Other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _vectors

LONG = (1 << 63) - 1
#: How many entries give a query its first floor, and how many pairs are probed at once.
FIRST, PAIRS = 256, 1 << 16


def scaled(rows: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), in Python's integers where 64-bit floats don't hold them all."""
    out = np.floor(scale * rows) if np.abs(rows).max(initial=0) < 2**900 else np.full(rows.shape, np.inf)
    if np.abs(out).max(initial=0) < 2**53:
        return out
    return np.array([[int(x) * scale if abs(x) >= 2**53 else int(np.floor(scale * x)) for x in r] for r in rows.tolist()], object).reshape(rows.shape)


def _narrowest(rows: np.ndarray, queries: np.ndarray) -> type:
    """The smallest type in which no sum of products loses anything."""
    most = max((int(x) for x in (np.abs(rows).max(initial=0), 1)), default=1) * int(np.abs(queries).max(initial=0)) * max(rows.shape[1], 1)
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def _integers(rows: np.ndarray, kind: type) -> np.ndarray:
    if kind is object and rows.dtype != object:
        return np.array([[int(x) for x in r] for r in rows.tolist()], object).reshape(rows.shape)
    return rows.astype(kind)


def competitive(rows: np.ndarray, queries: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, query) pairs that can reach the query's floor: essential postings are traversed, the rest is bounded."""
    postings = np.hstack([np.maximum(rows, 0), np.maximum(-rows, 0)])
    terms = np.hstack([np.maximum(queries, 0), np.maximum(-queries, 0)])
    bounds = terms * postings.max(axis=0, initial=0)
    order = np.argsort(-bounds, axis=1, kind="stable")
    left = np.take_along_axis(bounds, order, axis=1)[:, ::-1].cumsum(axis=1)[:, ::-1]
    essential = np.zeros(terms.shape, bool)
    np.put_along_axis(essential, order, left >= floors[:, None], axis=1)
    rest = np.where(essential, 0, bounds).sum(axis=1)
    upper = postings @ np.where(essential, terms, 0).T
    return np.nonzero(upper + rest >= floors)


def search_cell(k: int, ids: np.ndarray, rows: np.ndarray, names: np.ndarray, queries: np.ndarray, floors: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of the best k of a shard for each query of a block, as far as they reach its floor.

    Bounds are floating-point numbers. Where these don't hold the scores, no bound is used and all terms are essential.
    """
    rows, queries = scaled(rows, scale), scaled(queries, scale)
    kind = _narrowest(rows, queries)
    rows, queries = _integers(rows, kind), _integers(queries, kind)
    if kind is object:
        score = np.array([max(min(s, LONG), -LONG - 1) for s in (rows @ queries.T).ravel().tolist()], np.int64)
        at, of = (x.ravel() for x in np.indices((len(rows), len(queries))))
        floors = np.full(len(queries), -LONG - 1)
    else:
        floors = np.where(np.isnan(floors), -np.inf, floors)
        _, first = np.unique(ids[: max(FIRST, 4 * k)], return_index=True)
        if len(first) > k:  # one more than k, for the query's own id
            floors = np.maximum(floors, np.sort(rows[first] @ queries.T, axis=0)[len(first) - k - 1])
        at, of = competitive(rows, queries, floors)
        if 4 * len(at) > len(rows) * len(queries):  # most are competitive: probe them in one product
            score = (rows @ queries.T)[at, of]
        else:
            parts = [(rows[at[i : i + PAIRS]] * queries[of[i : i + PAIRS]]).sum(axis=1) for i in range(0, len(at), PAIRS)]
            score = np.concatenate(parts) if parts else np.zeros(0)
        score = score.astype(np.int64)
    kept = (score >= floors[of]) & (ids[at] != names[of])
    at, of, score = at[kept], of[kept], score[kept]
    found = _vectors.best(of, ids[at], ~score, k)  # ~ turns the order around and stays in a long
    return of[found], ids[at][found], score[found]


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the highest inner product of floor(scale * x), exactly.

    A query doesn't find rows of its own id.
    """

    def cell(*given) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return search_cell(*given, scale)

    entries = _vectors.shards(_vectors.usable(vectors, id_col, vector_col), "maxscore-shards")
    asked = _vectors.usable(queries, id_col, vector_col)
    return _vectors.rounds(entries, asked, k, cell, "long", F.col("score").desc(), worst=F.min)
