"""Suffix-array dedup against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from daymill.llm import entry, suffix


def brute(texts, window):
    """(n_bytes, n_removed, n_spans, kept) of each text."""
    texts = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - window + 1):
            if seen[t[i : i + window]] > 1:
                gone[i : i + window] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def texts(seed=3, n=120):
    rnd = np.random.default_rng(seed)
    words = ["".join(rnd.choice(list("abcdeéß漢"), rnd.integers(1, 7))) for _ in range(60)]
    prose = lambda k: " ".join(rnd.choice(words, k))
    passage, copy = prose(40), prose(60)
    rows = [prose(int(rnd.integers(0, 80))) for _ in range(n)]
    rows += [prose(9) + passage + prose(int(rnd.integers(1, 9))) for _ in range(30)]  # one passage in many texts
    rows += [copy] * 5 + [copy[:90] + "X" + copy[91:], copy[:60], None, "", "a" * 900, "ab" * 300, "aba" * 200, "a" * 41, "\0" * 90, passage + passage]
    return rows


@pytest.mark.parametrize(("window", "most"), [(40, 512), (40, 3), (64, 1), (9, 2)])
def test_against_brute_force(spark, monkeypatch, window, most):
    monkeypatch.setattr(suffix, "MOST", most)
    monkeypatch.setattr(suffix, "LEVELS", (5, 1))
    monkeypatch.setattr(suffix, "BUCKET_BYTES", 3000)
    rows = texts()
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(rows)], "doc_id long, text string, key string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix.deduplicate(df, window=window).collect()}
    assert [got[i] for i in range(len(rows))] == brute(rows, window)


def test_rows_that_repeat(spark):
    rows = [(1, "x" * 400), (1, "x" * 400), (None, "y" * 399 + "z"), (None, "y" * 399 + "z"), (2, "q" * 399), (2, "q" * 399), (7, "".join(map(chr, range(200, 700))))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix.deduplicate_digests(df).collect()))
    none = hashlib.sha256(b"").hexdigest()
    assert got[:4] == [(0, 400, 1, none)] * 2 + [(1, 400, 1, none)] * 2
    assert [x[1] for x in got[4:]] == [0, 0, 0] and got[4][3] == hashlib.sha256(b"q" * 399).hexdigest()
    assert suffix.deduplicate(df.filter("doc_id = 99")).count() == 0


def test_long_texts_in_stripes(monkeypatch):
    rnd = np.random.default_rng(1)
    text = bytes(rnd.integers(97, 100, 3000, np.uint8))
    whole = {(a, s) for first, last, a in suffix.pieces(text, 50) for s in range(first, last + 1)}
    monkeypatch.setattr(suffix, "STRIPE", 333)
    assert {(a, s) for first, last, a in suffix.pieces(text, 50) for s in range(first, last + 1)} == whole
    assert sorted(s for _, s in whole) == [*range(len(text) - 49)]
    assert all(s <= a < s + suffix.cover(50) for a, s in whole)


def test_suffixes_are_in_order():
    rnd = np.random.default_rng(4)
    for letters in (1, 2, 3, 26, 256):
        text = rnd.integers(0, letters, 700).astype(np.uint8)
        raw = text.tobytes()
        order = suffix.suffixes(text, 700)
        assert order.tolist() == sorted(range(700), key=lambda i: raw[i:])
        cut = suffix.suffixes(text, 6).tolist()
        assert sorted(cut) == [*range(700)] and [raw[i : i + 6] for i in cut] == sorted(raw[i : i + 6] for i in cut)
        wanted = rnd.random(700) < 0.2
        some = suffix.suffixes(text, 700, wanted)
        assert some[wanted[some]].tolist() == [i for i in order.tolist() if wanted[i]]
    assert len(suffix.suffixes(np.zeros(0, np.uint8), 5)) == 0


def test_query_on_whole_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = brute([r.text for r in rows], 400)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in entry.QUERIES["op12_suffix_array"](spark, sf_dir).collect()}
    assert [got[r.doc_id] for r in rows] == [(*w[:3], hashlib.sha256(w[3]).hexdigest()) for w in want]
    assert any(w[1] for w in want)
