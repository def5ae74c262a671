"""Vector searches against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymill.llm import forest, maxscore


def vectors(spark, n=1500, dim=12, seed=1):
    rnd = np.random.default_rng(seed)
    centers = rnd.standard_normal((5, dim))
    rows = [(i, [float(np.float32(x)) for x in centers[i % 5] + 0.5 * rnd.standard_normal(dim)], "x") for i in range(n)]
    same = [0.25] * dim
    rows += [(n + i, same, "same") for i in range(400)]
    rows += [(5000, None, ""), (5001, [0.0] * dim, ""), (5002, [1.0, None] + [0.0] * (dim - 2), ""), (5003, [math.nan] * dim, ""), (5004, [math.inf] + [0.0] * (dim - 1), ""), (None, same, ""), (5005, [1.0, 2.0], ""), (5006, [1.0, 3.0], ""), (5007, [], ""), (n, same, "again"), (20, rows[40][1], "same id")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, v string"), rows


def brute(rows, every, k, score, zero):
    ok = {(i, tuple(v)) for i, v, _ in rows if i is not None and v is not None and None not in v and all(map(math.isfinite, v)) and (zero or any(v))}
    out = {}
    for q, v in ok:
        if q % every == 0:
            found = sorted((score(v, w), i) for i, w in ok if i != q and len(w) == len(v))
            out.setdefault(q, []).append(found)
    return {q: sorted(x for f in found for x in f)[:k] if len(found) > 1 else found[0][:k] for q, found in out.items()}


def test_maxscore_is_exact(spark):
    df, rows = vectors(spark)
    rows = [r for r in rows if r[2] != "same id"]
    df = df.filter("v <> 'same id'")
    got = maxscore.search(df, df.filter("vec_id % 20 = 0"), k=20).collect()
    want = brute(rows, 20, 20, lambda a, b: -sum(math.floor(64 * x) * math.floor(64 * y) for x, y in zip(a, b)), True)
    mine = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        mine.setdefault(r.query_id, []).append((-r.score, r.vec_id))
    assert mine == {q: w for q, w in want.items() if w}


def test_maxscore_of_large_components(spark):
    df = spark.createDataFrame([(0, [1e30, 1.0]), (20, [1e30, -1.0]), (21, [1e6, 5.0]), (22, [-1e30, 0.5])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in maxscore.search(df, df.filter("vec_id % 20 = 0")).collect()}
    assert got[0, 1] == (20, (1 << 63) - 1) and got[0, 3] == (22, -1 << 63)


def test_forest_recall_and_ties(spark):
    df, rows = vectors(spark)
    df, rows = df.filter("v <> 'same id'"), [r for r in rows if r[2] != "same id"]
    got = forest.search(df, df.filter("vec_id % 100 = 0"), k=10).collect()
    want = brute(rows, 100, 10, lambda a, b: float(np.sqrt(((np.array(a) - np.array(b)) ** 2).sum())), False)
    mine = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        mine.setdefault(r.query_id, []).append((r.score, r.vec_id))
    hits = sum(len({i for _, i in w} & {i for _, i in mine.get(q, [])}) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert [i for _, i in mine[1500]] == list(range(1501, 1511))
    scores = {(q, i): s for q, w in want.items() for s, i in w}
    assert all(s == pytest.approx(scores[q, i], abs=1e-12) for q, m in mine.items() for s, i in m if (q, i) in scores)


def test_all_candidates_if_fewer(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (100, [0.0, 1.0]), (7, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert forest.search(df, df.filter("vec_id % 100 = 0")).count() == 4
    assert maxscore.search(df, df.filter("vec_id % 20 = 0")).count() == 4
    none = df.filter(F.lit(False))
    assert forest.search(none, none).count() == 0 and maxscore.search(none, none).count() == 0


def test_hash_strings_match_prefixes():
    rnd = np.random.default_rng(3)
    f = forest.Forest(rnd.standard_normal((500, 8)), trees=4)
    for q, c in zip(range(20), f.candidates(f.vectors[:20], 40)):
        assert q in c and len(c) >= 10


def test_one_id_on_several_vectors(spark):
    rnd = np.random.default_rng(8)
    rows = [(i % 90, [float(np.float32(x)) for x in rnd.standard_normal(6)]) for i in range(300)]
    df = spark.createDataFrame(rows + rows[:40], "vec_id long, embedding array<float>")
    for operator, every, k, cost in ((maxscore, 20, 5, lambda a, b: -sum(math.floor(64 * x) * math.floor(64 * y) for x, y in zip(a, b))), (forest, 100, 90, math.dist)):
        pairs = {}
        for q, v in rows:
            for i, w in rows:
                if q % every == 0 and i != q:
                    pairs[q, i] = min(pairs.get((q, i), math.inf), cost(v, w))
        want = {(q, r): i for q in {q for q, _ in pairs} for r, (_, i) in enumerate(sorted((c, i) for (p, i), c in pairs.items() if p == q)[:k], 1)}
        got = operator.search(df, df.filter(F.col("vec_id") % every == 0), k=k).collect()
        assert {(r.query_id, r["rank"]): r.vec_id for r in got} == want


@pytest.mark.parametrize("size", [4, 40_000])
def test_shards_in_rounds_change_nothing(spark, monkeypatch, size):
    df, rows = vectors(spark, n=400)
    df = df.filter("v <> 'same id'")
    want = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in maxscore.search(df, df.filter("vec_id % 20 = 0"), k=20).collect()}
    monkeypatch.setattr("daymill.llm._vectors.SHARD_BYTES", 3000)
    monkeypatch.setattr("daymill.llm._vectors.BLOCK_ROWS", size)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in maxscore.search(df, df.filter("vec_id % 20 = 0"), k=20).collect()}
    assert got == want
    assert forest.search(df, df.filter("vec_id % 100 = 0"), k=3, share=16.0).count() == len({r[0] for r in rows if r[0] is not None and r[0] % 100 == 0 and r[1] and len(r[1]) == 12}) * 3


def test_numbers_of_every_size_score_exactly():
    rnd = np.random.default_rng(2)
    for size in (1.0, 1e3, 1e9, 1e17, 1e200):
        rows, ids = rnd.standard_normal((300, 5)) * size, np.arange(300)
        of, at, score = maxscore.search_cell(4, ids, rows, ids[:10], rows[:10], np.full(10, np.nan), 64)
        whole = lambda x: math.floor(64 * x) if abs(x) < 2**53 else int(x) * 64
        cut = lambda x: max(min(x, (1 << 63) - 1), -1 << 63)
        for q in range(10):
            want = sorted((-cut(sum(whole(a) * whole(b) for a, b in zip(rows[q], r))), i) for i, r in enumerate(rows) if i != q)[:4]
            assert [(-int(s), int(i)) for o, i, s in zip(of, at, score) if o == q] == want
