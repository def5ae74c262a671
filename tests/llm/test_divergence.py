"""Source divergence against brute force in Python's integers."""

import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from daymill.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, term string, n long, g int"


def brute(rows, least=30, most=50):
    found = {}
    for i, (text, lang, source) in enumerate(rows):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found.setdefault((lang or "", source or ""), []).append(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered))
    out = []
    for lang in {k for k, _ in found}:
        groups = {s: docs for (k, s), docs in found.items() if k == lang}
        rows_of = Counter(t for docs in groups.values() for d in docs for t in set(d))
        kept = {t for t, n in rows_of.items() if n >= least}
        counts = {s: Counter(t for d in docs for t in d if t in kept) for s, docs in groups.items()}
        share = lambda c, t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))
        p = {s: {t: share(c, t) for t in kept} for s, c in counts.items()}
        q = {t: share(sum(counts.values(), Counter()), t) for t in kept}
        for s in groups:
            pairs = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s)
            ahead = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t])[:most]
            for part, items in (("pair", pairs), ("term", ahead)):
                out += [(lang, s, part, item, -v, r) for r, (v, _, item) in enumerate(items, 1)]
    return sorted(out)


def rows(seed=1, n=400):
    rnd = random.Random(seed)
    words = ["the", "The", "of", "Éa", "éa", "x1y", "ça", "漢字", "a_b", "don't", "😀ok", "\u00a0"] + [f"w{chr(97 + i)}" for i in range(20)]
    out = []
    for i in range(n):
        weights = [rnd.random() ** 4 + (i % 5 == k % 5) for k in range(len(words))]
        out.append((" ".join(rnd.choices(words, weights, k=rnd.randrange(0, 40))), rnd.choice(["en", "fr", None]), f"s{rnd.randrange(6)}" if i % 3 else "hot"))
    return out + [(None, "en", "empty"), ("", "en", None), ("\0 1 2", "zz", "a"), ("few words", "zz", "b"), (None, None, None), ("the", "only", "one")]


@pytest.mark.parametrize("postings", [(1 << 14, 1 << 20), (5, 25)])
def test_against_brute_force(spark, monkeypatch, postings):
    monkeypatch.setattr(divergence, "POSTINGS", postings)
    monkeypatch.setattr(divergence, "HELD", 40)
    data = rows()
    df = spark.createDataFrame([(i % 7, *r, "k", 1, 2) for i, r in enumerate(data)], SCHEMA)
    got = sorted(tuple(r) for r in divergence.audit(df, least=20, most=5).collect())
    want = brute(data, 20, 5)
    assert got == want and {x[2] for x in got} == {"pair", "term"}


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shares_are_exact_where_longs_are_not(spark):
    n, total, kept = 10**15 + 7, 3 * 10**16 + 11, 123_457
    df = spark.createDataFrame([(n, total, kept)], "n long, total long, v long")
    assert df.select(divergence.share(df.n, df.total, df.v)).first()[0] == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_accumulated_rows_equal_dense_ones(monkeypatch):
    monkeypatch.setattr(divergence, "GATHERED", 50)
    rnd = np.random.default_rng(4)
    base = rnd.integers(1, 50, 9)
    dense = np.where(rnd.random((9, 80)) < 0.3, base[:, None] + rnd.integers(0, 1000, (9, 80)), 0)
    g, t = np.nonzero(dense)
    a, b, value = divergence.accumulate(pd.DataFrame({"term": t.astype(str), "g": g, "p": dense[g, t]}), base)
    full = np.where(dense > 0, dense, base[:, None])
    for i in range(9):
        for j in range(i + 1, 9):
            got = value[(a == i) & (b == j)].sum() + 80 * abs(int(base[i]) - int(base[j]))
            assert got == np.abs(full[i] - full[j]).sum()
