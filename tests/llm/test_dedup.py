"""SimHash and substring deduplication against brute force."""

import hashlib
import random
import re

import pytest
import xxhash

from daymill.llm import similar, simhash, substring


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, fp string, bucket string")


def brute_components(rows, words=3):
    fps = [simhash.fingerprint(t or "", words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, fps[i], least[root(i)]) for i, (d, _) in enumerate(rows))


def some_texts(n, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["É", "ß", "日本", "x\x85y", "a\xa0b"]
    base = [[rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 2, 40, 55, 120, 300]))] for _ in range(n)]
    shared = [rnd.choice(vocabulary) for _ in range(70)]
    texts = []
    for i, w in enumerate(base):
        if i % 4 == 1 and i:
            w = list(base[i - 1])
            if w and i % 8 == 1:
                w[rnd.randrange(len(w))] = "changed"
        if i % 5 == 2:
            at = rnd.randrange(len(w) + 1)
            w = w[:at] + shared[: rnd.choice([49, 50, 63, 70])] + w[at:]
        texts.append((" " if i % 3 else "\n\t ").join(w))
    return texts + [None, "", "   ", "same " * 200, "same " * 260, texts[5], texts[5]]


@pytest.mark.parametrize("bucket", [64, 1])
def test_components_equal_brute_force(spark, bucket):
    rows = list(enumerate(some_texts(120, 3)))
    base = "one two three four five six seven eight nine ten".split() * 9
    for i in range(40):
        rows.append((1000 + i, " ".join(base + [f"t{i % 7}"] * (i % 5))))
    rows.append((3, "a repeated id"))
    random.Random(1).shuffle(rows)
    got = simhash.near_duplicates(table(spark, [(d, t, "x", "y") for d, t in rows]), bucket=bucket).collect()
    assert sorted((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in got) == brute_components(rows)


def test_stars_join_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(500, 501), (501, 502), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 101)}, 501: 500, 502: 500}


def test_golay_keys_meet_within_two_bits():
    golay, rnd = simhash.GolayKeys(), random.Random(2)
    import numpy as np

    for _ in range(300):
        x = rnd.getrandbits(64)
        y = x
        for b in rnd.sample(range(64), rnd.choice([0, 1, 2])):
            y ^= 1 << b
        keys = golay.keys(np.array([x, y], np.uint64).view(np.int64))
        assert set(keys[0]) & set(keys[1])


def test_empty_table(spark):
    assert simhash.near_duplicates(table(spark, [])).count() == 0
    assert substring.deduplicate(table(spark, [])).count() == 0


def brute_substring(rows):
    n = substring.WINDOW
    words = [(d, (t or "").encode().split()) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < d:
                gone.update(range(i, i + n))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), kept.decode(), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_equals_brute_force(spark, seed):
    rows = list(enumerate(some_texts(150, seed)))
    rows.append((4, rows[40][1]))
    random.Random(seed).shuffle(rows)
    want = brute_substring(rows)
    docs = table(spark, [(d, t, "x", "y") for d, t in rows]).repartition(5)
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring.deduplicate(docs).collect())
    assert got == [x[:4] for x in want]
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring.deduplicate_digests(docs).collect())
    assert got == [(*x[:3], x[4]) for x in want]


def test_null_ids_lose_to_others(spark):
    text = " ".join(f"w{i}" for i in range(60))
    got = substring.deduplicate(table(spark, [(None, text, "", ""), (5, text, "", "")])).collect()
    assert {r.doc_id: r.n_removed for r in got} == {None: 60, 5: 0}
    got = simhash.near_duplicates(table(spark, [(None, text, "", ""), (5, text, "", "")])).collect()
    assert {r.doc_id: r.component_id for r in got} == {None: 5, 5: 5}


def test_cover_takes_any_two_positions_along():
    for a in range(substring.PERIOD):
        for b in range(substring.PERIOD):
            assert any((a + s) % substring.PERIOD in substring.COVER and (b + s) % substring.PERIOD in substring.COVER for s in range(substring.PERIOD))


def plain_fingerprint(text, words):
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in re.findall("[^\x20\x09-\x0d]+", text)]
    found = [" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] if len(w) > words else [" ".join(w)] if w else []
    h = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in found]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_by_the_rule():
    texts = [t or "" for t in some_texts(80, 5)] + ["Ä É ı\x85x\u2003y a\x1cb", "A B", "a b c", "A b\tC\x0bd", "x " * 500]
    assert [simhash.fingerprint(t) for t in texts] == [plain_fingerprint(t, 3) for t in texts]


@pytest.mark.parametrize("operator", [simhash, similar])
def test_one_id_on_two_texts(spark, operator):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(5, a, "x", "y"), (5, b, "x", "y"), (5, b, "x", "y"), (7, a, "x", "y"), (None, a, "x", "y"), (8, None, "x", "y"), (9, "", "x", "y")]
    got = sorted(((r.doc_id, r.text) for r in operator.keep_one(table(spark, rows)).collect()), key=str)
    assert got == sorted([(5, a), (5, b), (None, a), (8, None)], key=str)
    assert operator.keep_one(table(spark, [])).count() == 0


def test_words_that_defeat_polynomial_digests(spark):
    """Thue-Morse words of 1,024 letters have the same polynomial modulo 2**64 as their complements, whatever the base."""
    first = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    rest = " ".join(f"shared{i}" for i in range(49))
    other = first.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{first} {rest}", "", ""), (2, f"{other} {rest}", "", ""), (3, f"{other} {rest} more", "", "")]
    got = {r.doc_id: r.n_removed for r in substring.deduplicate(table(spark, rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 50}
    words = substring.Words([first.encode(), other.encode()]).word
    assert all(w[0] != w[1] for w in words) and words[0][0] != words[1][0]
