"""Hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymill.llm import gnat

COLUMNS = "vec_id long, embedding array<double>, label int, score string, n int"


def brute(rows, every, positives=5, negatives=10, scale=256):
    cut = lambda x: max(min(x, (1 << 63) - 1), -1 << 63)
    whole = lambda x: int(x) * scale if abs(x) >= 2**53 else math.floor(scale * x)
    rows = {(i, label, tuple(v)) for i, v, label in rows if i is not None and label is not None and v is not None and None not in v and all(map(math.isfinite, v))}
    rows = [(i, label, [whole(x) for x in v]) for i, label, v in rows]
    out = []
    for a, own, v in rows:
        if a % every:
            continue
        scores = [(i, label == own, cut(sum(x * y for x, y in zip(v, w)))) for i, label, w in rows if i != a and len(w) == len(v)]

        def best(k, fits):
            found = {}
            for i, same, s in scores:
                if fits(same, s):
                    found[i] = max(found.get(i, s), s)
            return sorted((-s, i) for i, s in found.items())[:k]

        for p, i in best(positives, lambda same, _: same):
            hard = best(negatives, lambda same, s: not same and 30 * -p <= 100 * s <= 90 * -p)
            out += [(a, i, r, j, -p, -s) for r, (s, j) in enumerate(hard, 1)]
    return sorted(out)


def vectors(seed=5, n=1200, dim=10):
    rnd = np.random.default_rng(seed)
    centers = rnd.standard_normal((7, dim))
    rows = [(i, [float(x) for x in (centers[i % 7] + 0.6 * rnd.standard_normal(dim)) / 3], int(rnd.integers(0, 4)) if i % 3 else 1) for i in range(n)]
    same = rows[9][1]
    rows += [(2000 + i, same, i % 2) for i in range(300)]  # one common vector
    return rows + [rows[0], (None, same, 1), (3000, None, 1), (3001, same, None), (3002, [math.nan] * dim, 1), (3003, [None] + same[1:], 1), (3004, [math.inf] + same[1:], 0), (3100, [0.0] * dim, 2), (3200, [1.0, 2.0], 0), (3300, [1.0, 1.0], 0), (3301, [0.5, 0.5], 1), (3400, [], 0)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", 3) for i, v, label in rows], COLUMNS)


def got(df, every, **more):
    found = gnat.mine(df, F.col("vec_id") % every == 0, **more)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize(("shard", "block"), [(1 << 20, 512), (3000, 7)])
def test_against_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(gnat, "SHARD_BYTES", shard)
    monkeypatch.setattr(gnat, "BLOCK_ROWS", block)
    rows = vectors()
    want = brute(rows, 100)
    assert len(want) > 500
    assert got(frame(spark, rows), 100) == want


def test_windows_and_numbers(spark):
    rows = vectors(n=60)
    assert got(frame(spark, rows), 10, positives=2, negatives=3) == brute(rows, 10, 2, 3)


@pytest.mark.parametrize("size", [1e7, 1e12, 1e200])
def test_large_components(spark, size):
    rnd = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rnd.standard_normal(4) * size], i % 3) for i in range(60)]
    assert got(frame(spark, rows), 10) == brute(rows, 10)


def test_one_id_on_several_rows(spark):
    rnd = np.random.default_rng(6)
    rows = [(i % 50, [float(x) for x in rnd.standard_normal(5)], i % 3) for i in range(150)]
    assert got(frame(spark, rows + rows[:20]), 10) == brute(rows, 10)


def test_empty_tables(spark):
    df = frame(spark, vectors(n=20))
    assert got(df.filter("vec_id < 0"), 100) == []
    assert got(df.filter("vec_id % 100 <> 0"), 100) == []


@pytest.mark.parametrize(("dim", "spread", "most_seen"), [(6, 0.3, 1.0), (3, 0.05, 0.5)])
def test_tree_reaches_all_that_a_window_holds(dim, spread, most_seen):
    rnd = np.random.default_rng(2)
    rows = rnd.standard_normal((3000, dim))
    rows = np.floor(rows / np.linalg.norm(rows, axis=1)[:, None] * (1 + spread * rnd.random((3000, 1))) * 256)
    queries, most = rows[:40], float((rows**2).sum(axis=1).max())
    tree, score = gnat.Tree(rows, most), rows @ queries.T
    low, high = np.sort(score, axis=0)[-90], np.sort(score, axis=0)[-30]
    seen = np.zeros((3000, 40), bool)
    for at, of in tree.leaves(queries, *gnat.annulus(queries, low, high, most)):
        seen[np.ix_(at, of)] = True
    inside = (score >= low) & (score <= high)
    assert inside.any() and (seen | ~inside).all() and seen.mean() <= most_seen
