"""What the vector searches share: reading vectors, packing them into bounded shards, rounds over the shards, merging.

Null vectors and vectors with null or non-finite components take no part, and neither do rows with a null id. Repeated
rows count once. Rows that share an id but not the vector are one item with several vectors: a pair of ids is scored by
the better of its vectors, and an item is never found by its own id. Vectors of different lengths don't meet.

Rows are dealt by a hash of id and vector into shards of about ``SHARD_BYTES``, so their number grows with the input and
a vector or an id that a third of all rows hold is spread like any other. Queries are packed into blocks of about
``BLOCK_ROWS`` rows in the same way. A cell is one block against one shard; both arrive as one binary value each, so a task
holds one cell at a time. Shards are searched in rounds, each of ``GROWTH`` times as many as before: a round takes the
k-th best that its queries have so far along, and returns only what is as good. So a query gets about k x GROWTH rows
back from each round, however many shards there are. One number, the most shards of any length, comes to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import materialise, small_batches

SHARD_BYTES = 4 << 20
BLOCK_ROWS = 512
GROWTH = 8

#: ids of the shard, its vectors, ids of the queries, their vectors and floors; gives query rows, found ids, scores.
Search = Callable[[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v array<double>) of the vectors that take part, repeated rows once."""
    v = F.col(vector_col).cast("array<double>")
    sound = F.forall("v", lambda x: F.coalesce(x > float("-inf"), F.lit(False)) & (x < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & sound)
    return rows.distinct()


def dealt(rows: DataFrame, each: Column) -> DataFrame:
    """rows with n (the vector's length), parts (how many parts its length has) and part; each: rows a part.

    The counts have one row a length: a million different lengths would take 4 TB of vectors, so they can be broadcast.
    """
    rows = rows.withColumn("n", F.size("v"))
    counts = rows.groupBy("n").agg(F.ceil(F.count("*") / each).cast("int").alias("parts"))
    return rows.join(F.broadcast(counts), "n").withColumn("part", F.pmod(F.xxhash64("vec_id", "v"), F.col("parts")).cast("int"))


def shards(rows: DataFrame, name: str) -> DataFrame:
    """(n, part, ids, m): the rows in packed shards, in a scratch table."""

    def pack(mine: pd.DataFrame) -> pd.DataFrame:
        ids, m = mine["vec_id"].to_numpy(np.int64), matrix(mine["v"])
        return pd.DataFrame({"n": mine["n"].iloc[:1], "part": mine["part"].iloc[:1], "ids": [ids.tobytes()], "m": [m.tobytes()]})

    size = F.greatest(F.lit(1), F.lit(SHARD_BYTES) / (8 * F.greatest(F.col("n"), F.lit(1))))
    return materialise(dealt(rows, size).groupBy("n", "part").applyInPandas(pack, "n int, part int, ids binary, m binary"), name)


def blocks(rows: DataFrame) -> DataFrame:
    """(n, ids, m, floors): the queries (with floor, null where there is none) in packed blocks."""

    def pack(mine: pd.DataFrame) -> pd.DataFrame:
        ids, m, floors = mine["vec_id"].to_numpy(np.int64), matrix(mine["v"]), mine["floor"].to_numpy(np.float64)
        return pd.DataFrame({"n": mine["n"].iloc[:1], "asked": [ids.tobytes()], "q": [m.tobytes()], "floors": [floors.tobytes()]})

    return dealt(rows, F.lit(float(BLOCK_ROWS))).groupBy("n", "part").applyInPandas(pack, "n int, asked binary, q binary, floors binary")


def matrix(column) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), -1)


def best(query: np.ndarray, ids: np.ndarray, cost: np.ndarray, k: int) -> np.ndarray:
    """Which rows are, for each query, the k of least cost with different ids; ties go to smaller ids."""
    if not len(ids):
        return np.zeros(0, np.int64)
    by_pair = np.lexsort((cost, ids, query))
    again = (query[by_pair][1:] == query[by_pair][:-1]) & (ids[by_pair][1:] == ids[by_pair][:-1])
    once = by_pair[np.r_[True, ~again]]
    order = once[np.lexsort((ids[once], cost[once], query[once]))]
    of = query[order]
    starts = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
    place = np.arange(len(of)) - np.repeat(starts, np.diff(np.r_[starts, len(of)]))
    return order[place < k]


def rounds(entries: DataFrame, asked: DataFrame, k: int, search: Search, type_: str, *order: Column, worst: Callable[[str], Column]) -> DataFrame:
    """(query_id, rank, vec_id, score): the best k of each query over all shards of entries.

    worst gives the score of the worst of several rows, the floor for later rounds.
    """
    spark = entries.sparkSession
    small_batches(spark)  # a row of cells holds a whole shard and a whole block
    most = entries.agg(F.max("part")).first()[0]
    found, low, high = None, 0, 1
    asked = materialise(asked, "vector-queries")

    def answer(cells: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in cells:
            for n, _, ids, m, names, q, floors in cell.itertuples(index=False):
                ids, names = np.frombuffer(ids, np.int64), np.frombuffer(names, np.int64)
                rows, queries = (np.frombuffer(x, np.float64).reshape(len(i), n) for x, i in ((m, ids), (q, names)))
                of, at, score = search(k, ids, rows, names, queries, np.frombuffer(floors, np.float64))
                yield pd.DataFrame({"query_id": names[of], "vec_id": at, "score": score})

    while most is not None and low <= most:
        rows = asked.withColumn("floor", F.lit(None).cast("double"))
        if found is not None:
            floors = found.groupBy(F.col("query_id").alias("vec_id")).agg(F.when(F.count("*") >= k, worst("score")).cast("double").alias("floor"))
            rows = asked.join(floors, "vec_id", "left")
        wide = blocks(rows).withColumn("part", F.explode(F.sequence(F.lit(low), F.lit(high - 1))))
        cells = entries.filter(F.col("part").between(low, high - 1)).join(wide.hint("merge"), ["n", "part"])
        met = cells.select("n", "part", "ids", "m", "asked", "q", "floors").mapInPandas(answer, f"query_id long, vec_id long, score {type_}")
        merged = met if found is None else met.unionByName(found)
        # a pair of ids that several of its vectors give is one row
        merged = merged.withColumn("again", F.row_number().over(Window.partitionBy("query_id", "vec_id").orderBy(*order))).filter("again = 1").drop("again")
        ranked = merged.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(*order, "vec_id"))).filter(F.col("rank") <= k)
        found = materialise(ranked.select("query_id", "rank", "vec_id", "score"), "vector-found").drop("rank") if high <= most else ranked
        low, high = high, high * GROWTH
    if found is None:
        return spark.createDataFrame([], f"query_id long, rank int, vec_id long, score {type_}")
    return found.select("query_id", "rank", "vec_id", "score")
