"""Toxicity: held-out accuracy on the test tables, and the defined results of odd rows."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from daymill.llm import toxicity

SCHEMA = "doc_id long, text string, score string"


def made(n, seed=1):
    rnd = random.Random(seed)
    syllables = ["on", "ther", "ing", "ed", "the", "an", "re", "ti", "sh", "wh", "ea"]
    rows, labels = [], []
    for i in range(n):
        w = ["".join(rnd.choice(syllables) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(30, 300))]
        if i % 5 == 0:
            for _ in range(6):
                w[rnd.randrange(len(w))] = rnd.choice(["dreadful", "nincompoop", "blockhead"])
        rows.append((i, " ".join(w), "x"))
        if i % 3:
            labels.append((i, int(i % 5 == 0)))
    return rows, labels


def test_held_out_documents_are_told_apart(spark):
    rows, labels = made(900)
    docs = spark.createDataFrame(rows, SCHEMA)
    out = toxicity.report(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    own = [r for r in out if r.held_out]
    assert sum(r.predicted == int(r.doc_id % 5 == 0) for r in own) >= 0.95 * len(own)


def test_labels_of_held_out_rows_are_not_learnt(spark):
    rows, labels = made(300)
    docs = spark.createDataFrame(rows, SCHEMA)
    turned = [(d, 1 - y if zlib.crc32(str(d).encode()) % 3 == 1 else y) for d, y in labels]
    a, b = (toxicity.learn(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (labels, turned))
    assert a == b


def test_odd_rows(spark):
    rows, labels = made(200)
    rows += [(None, "dreadful " * 50, None), (7000, None, None), (7001, "", None), (7002, "nincompoop dreadful " * 20000, None), (7002, "nincompoop dreadful " * 20000, None)]
    labels += [(None, 1), (9999, 1), (7001, None)]
    docs, labels = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    out = toxicity.report(docs, labels).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert by[7000].score == by[7001].score < 0.5 and by[None].held_out is False
    kept = toxicity.keep_ordinary(docs, labels)
    assert kept.columns == docs.columns
    assert 7000 in {r.doc_id for r in kept.collect()}


@pytest.mark.parametrize("toxic", [0, 1])
def test_one_class_or_none(spark, toxic):
    docs = spark.createDataFrame(made(20)[0], SCHEMA)
    labels = spark.createDataFrame([(i, toxic) for i in range(20)], "doc_id long, toxic int")
    assert toxicity.report(docs, labels).select("score").distinct().count() == 1
    none = docs.filter(F.lit(False))
    assert toxicity.report(none, labels.filter(F.lit(False))).count() == 0


def plain_score(model, text):
    """One text's score, window by window with one compressor each, in plain Python."""
    import math

    import zstandard

    def size(dictionary, window):
        params = zstandard.ZstdCompressionParameters.from_level(toxicity.LEVEL, min_match=4, write_content_size=False, write_checksum=False, write_dict_id=False)
        held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(dict_data=held, compression_params=params).compress(window))

    w = [x.lower() for x in text.encode().split()]
    parts = [b" " + b" ".join(w[i : i + 12]) + b" " for i in range(0, len(w), 12)] or [b" "]
    ahead = [size(model.ordinary, p) - size(model.toxic, p) for p in parts]
    x = [1.0, max(ahead), *(math.log1p(sum(a >= t for a in ahead)) for t in toxicity.THRESHOLDS), math.log1p(len(parts))]
    total = sum((v - c) / s * k for v, c, s, k in zip(x, model.center, model.scale, model.weights, strict=True))
    return 1 / (1 + math.exp(-max(-30, min(30, total))))


def test_scores_equal_a_plain_computation(spark):
    rows, labels = made(300, seed=4)
    rows += [(1000, "", "x"), (1001, None, "x"), (1002, "É " * 50 + "nincompoop", "x"), (1003, "one", "x")]
    docs = spark.createDataFrame(rows, SCHEMA)
    model = toxicity.learn(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model.center and model.ordinary != model.toxic
    got = {r.doc_id: r.score for r in toxicity.score(docs.select("doc_id", "text"), model).collect()}
    for i, text, _ in rows[::7] + rows[-4:]:
        assert got[i] == pytest.approx(plain_score(model, text or ""), abs=1e-12)
