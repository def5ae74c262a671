"""Mixing against the same arithmetic in Python."""

import math
import random
from collections import Counter, defaultdict

import pytest

from daymill.llm import mixing

SCHEMA = "doc_id long, text string, source string, at string"


def rows_of(seed=1):
    rnd = random.Random(seed)
    rows = [(i, " ".join(["w"] * rnd.randrange(1, 60)), "hot" if i % 2 else f"s{i % 14}", "a") for i in range(600)]
    return rows + [(600, None, "s2", ""), (601, "", "none", ""), (602, "x y", None, ""), (602, "x y", None, ""), (None, "z", "s2", "")]


def brute(rows, target, repetitions):
    sums = Counter()
    for _, t, s, _ in rows:
        sums[s] += len((t or "").split())
    known = {s: n for s, n in sums.items() if n}
    total, most = sum(known.values()), max(known.values())

    def entropy(a):
        x = [(n / total) ** a for n in known.values()]
        return -sum(v / sum(x) * math.log(v / sum(x)) for v in x)

    a = max(k for k in range(mixing.STEPS + 1) if entropy(k / mixing.STEPS) >= target * math.log(len(known)) - 1e-12)
    while any((most / n) ** (1 - a / mixing.STEPS) > repetitions + 1e-9 for n in known.values()):
        a += 1
    return a / mixing.STEPS, {s: math.floor((most / n) ** (1 - a / mixing.STEPS) * n) for s, n in known.items()}, sums


@pytest.mark.parametrize("target,repetitions", [(0.95, 2.0), (0.5, 3.0), (1.0, 1e9), (0.99, 1.0)])
def test_mix(spark, target, repetitions):
    rows = rows_of()
    docs = spark.createDataFrame(rows, SCHEMA)
    out = mixing.report(docs, target=target, repetitions=repetitions, blocks=8).collect()
    a, budget, sums = brute(rows, target, repetitions)
    source_sums = spark.createDataFrame(list(sums.items()), "source string, tokens long")
    assert mixing.exponent(source_sums, target, repetitions) == a
    assert Counter((r.doc_id, r.source) for r in out if r.epoch == 0) == Counter((d, s) for d, _, s, _ in rows)
    places = defaultdict(list)
    for r in out:
        places[r.source].append((r.at, r.n_tokens, r.block, r.epoch))
        if sums[r.source]:
            assert r.at // sums[r.source] == r.epoch or r.n_tokens == 0
            assert r.at < budget[r.source] or r.n_tokens == 0
            assert r.block == min(7, math.floor(r.at * 8.0 / budget[r.source]))
    for s, n in sums.items():
        if n and s is not None:
            at = 0
            for place, size, _, _ in sorted(places[s]):
                assert place == at
                at += size
            assert budget[s] <= at < budget[s] + 60


def test_columns_and_empty_tables(spark):
    docs = spark.createDataFrame(rows_of(), SCHEMA)
    assert mixing.mixed(docs).columns == docs.columns
    assert mixing.mixed(docs.limit(0)).count() == 0
    one = spark.createDataFrame([(1, "a b", "s", "")], SCHEMA)
    assert mixing.report(one).collect()[0].asDict() == {"doc_id": 1, "source": "s", "block": 0, "epoch": 0, "at": 0, "n_tokens": 2}


def test_order_is_a_permutation_by_hash(spark):
    docs = spark.createDataFrame([(i, "a b c", "s", "") for i in range(50)], SCHEMA)
    a = [r.doc_id for r in mixing.report(docs).orderBy("at").collect()]
    b = [r.doc_id for r in mixing.report(docs, seed=7).orderBy("at").collect()]
    assert sorted(a) == sorted(b) == list(range(50)) and a != b != sorted(b)
