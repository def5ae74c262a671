"""Near copies by Jaccard similarity against brute force over all pairs."""

import random

import corpus_pipeline as pipeline
import pytest

from daymill.llm import similar, simhash


def groups(rows):
    """The indices of the rows of each component."""
    sets = [frozenset(simhash.shingles(t or "", 5)) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            x = len(a & b)
            if a == b or (x and 5 * x >= 4 * (len(a) + len(b) - x)):
                parent[root(i)] = root(j)
    out = {}
    for i in range(len(rows)):
        out.setdefault(root(i), []).append(i)
    return list(out.values())


def brute(rows):
    found = [[rows[i][0] for i in g] for g in groups(rows)]
    # a repeated id may be in several components; each of its rows has its own
    return sorted((d, min(g)) for g in found for d in g)


def edited_texts(seed):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(3000)}"
    line = [word() for _ in range(30)]
    texts = [None, "", " ", "one two", "one two", "One  two"]
    for size in (5, 8, 12, 40, 100, 300):
        for _ in range(6):
            base = [word() for _ in range(size)] + (line if rnd.random() < 0.5 else [])
            for _ in range(rnd.choice([1, 2, 6])):
                copy = list(base)
                for _ in range(rnd.randrange(1 + len(base) // 30)):
                    copy[rnd.randrange(len(copy))] = word()
                texts.append(" ".join(copy[rnd.randrange(3) :]))
    base = [word() for _ in range(120)]
    for _ in range(50):
        copy = list(base)
        for _ in range(rnd.randrange(6)):
            copy[rnd.randrange(120)] = word()
        texts.append(" ".join(copy))
    rows = list(enumerate(texts)) + [(7, " ".join(base)), (7, "another text of a repeated id")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("bucket", [16, 2])
def test_components_equal_brute_force(spark, bucket):
    rows = edited_texts(4)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, similar.similar_components(docs, bucket=bucket).collect()))
    assert got == brute(rows)


def test_bitmaps_differ_no_more_than_sets():
    sets = [similar.shingle_set(t or "") for _, t in edited_texts(6)]
    for a in sets[::3]:
        for b in sets[::5]:
            x, y = similar.bitmap(a), similar.bitmap(b)
            while len(x) != len(y):
                x, y = (z if len(z) == min(len(x), len(y)) else z[: len(z) // 2] ^ z[len(z) // 2 :] for z in (x, y))
            differ = sum(bin(int(z)).count("1") for z in (x ^ y).view("uint64"))
            assert differ <= len(set(a.tolist()) ^ set(b.tolist()))


def test_stage_removes_edited_copies(spark, sf_dir):
    rows = edited_texts(5) + [(None, "one two")]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, source string")
    out = pipeline.drop_near_copies(spark, docs, sf_dir)
    assert out.columns == docs.columns
    named = [r for r in rows if r[0] is not None]
    kept, found = [(r.doc_id, r.text) for r in out.collect() if r.doc_id is not None], groups(named)
    assert sorted(d for d, _ in kept) == sorted(min(named[i][0] for i in g) for g in found)
    assert all(sum((d, t) in kept for d, t in {named[i] for i in g}) == 1 for g in found)
    assert out.filter("doc_id IS NULL").count() == 1


def test_fingerprints_give_candidates(spark):
    """The stage had no SimHash: texts whose fingerprints lie within two bits must be candidates, or linked by such."""
    rnd = random.Random(6)
    fps = [rnd.getrandbits(63) for _ in range(30)]
    fps += [f ^ 1 << rnd.randrange(63) for f in fps[:15]] + [f ^ 1 << 3 ^ 1 << rnd.randrange(10, 63) for f in fps[5:20]] + [f ^ 7 for f in fps[:5]] + fps[:4]
    nodes = [*enumerate(fps)]
    pairs = {tuple(r) for r in similar.fingerprint_pairs(spark.createDataFrame(nodes + nodes[:9], "node long, fp long")).collect()}
    near = {(a, b) for a, x in nodes for b, y in nodes if a < b and (x ^ y).bit_count() <= 2}
    groups = lambda edges: _groups(len(nodes), edges)
    assert pairs <= near and groups(pairs) == groups(near) and len(near) > 30


def _groups(n, edges):
    root = [*range(n)]
    for _ in range(n):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    return root


def test_plans_and_rounds_are_bounded(spark, monkeypatch):
    """The driver holds a written plan's stages at once, so none has dozens; links that are stars already take no round."""
    rnd = random.Random(8)
    rows = []
    for i in range(20):
        w = [rnd.choice("abcdefghij") * rnd.randint(1, 5) for _ in range(120)]
        rows += [(10 * i + j, " ".join(w[:60] + [f"x{j}"] + w[60:])) for j in range(3)]
    written = []
    for module in (similar, simhash):
        write = module.materialise

        def counted(df, name, write=write):
            written.append((name, df._jdf.queryExecution().sparkPlan().toString().count("Join") + df._jdf.queryExecution().sparkPlan().toString().count("Window")))
            return write(df, name)

        monkeypatch.setattr(module, "materialise", counted)
    got = similar.similar_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(i, i // 10 * 10) for i, _ in rows}
    assert max(n for _, n in written) <= 6, written
    written.clear()
    edges = spark.createDataFrame([(1, i) for i in range(2, 30)] + [(50, 51), (50, 51), (50, 52)], "a long, b long")
    assert {(r.node, r.root) for r in simhash.components(edges).collect()} == {(i, 1) for i in range(2, 30)} | {(51, 50), (52, 50)}
    assert [name for name, _ in written] == ["links"]
