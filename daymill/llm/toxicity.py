"""Toxicity by compression distance.

Two zstandard dictionaries are trained, on ordinary text and on toxic text. The ordinary one is trained on windows of
ordinary documents. The toxic one holds the same ordinary content, and before it what toxic documents share and
ordinary ones lack: words whose share of toxic documents is ``TIMES`` that of ordinary ones, taken until they cover the
toxic documents or are frequent in them. So a window compresses to the same length with both unless it holds such
text. A document's windows of ``WINDOW`` words are compressed with each; how far the toxic dictionary is ahead, at
most and how often above each threshold, goes into a logistic model that is calibrated on documents the dictionaries
were not trained on.

Training takes a bounded sample of labelled rows: at most ``MOST_TOXIC`` and ``MOST_ORDINARY`` documents, in the order
of a hash of their ids, of ``MOST_CHARS`` characters together; documents of over ``MOST_TRAINED`` characters aren't
learnt from, and the ordinary dictionary is trained on at most ``MOST_WINDOWS`` of the sample's windows, drawn at
random. All texts are scored whole.

Nulls: a null text is empty and an empty text scores as one window without words; labels that are null or name no
document aren't used; an id that is labelled both toxic and not counts as toxic; a row with a null id is scored and not
held out. With fewer than ``LEAST_LABELLED`` toxic or ordinary texts, every score is the smoothed share of toxic labels.
Repeated rows score alike; an empty table gives an empty result. Other columns of the input are kept by
``keep_ordinary``.
"""

from __future__ import annotations

import random
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import small_batches, text_or_empty

#: Bounds of the training sample, and the least texts of each label to train on.
MOST_TOXIC, MOST_ORDINARY, MOST_CHARS = 2000, 5000, 48_000_000
MOST_TRAINED, MOST_WINDOWS, LEAST_LABELLED = 3_000_000, 30_000, 4
WINDOW = 12
THRESHOLDS = (2, 3, 4, 5, 6)
TIMES, LEAST_DOCUMENTS, MOST_WORDS, FREQUENT = 10, 5, 256, 0.05
DICTIONARY_BYTES = 32768
LEVEL = 9
REJECT = 0.7


class Model(NamedTuple):
    ordinary: bytes
    toxic: bytes
    weights: list[float]
    center: list[float]
    scale: list[float]


def held_out(id_: Column) -> Column:
    """Labels of these rows are never learnt from."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def windows(text: str) -> list[bytes]:
    w = text.encode("utf-8", "surrogatepass").lower().split()
    return [b" " + b" ".join(w[i : i + WINDOW]) + b" " for i in range(0, len(w), WINDOW)] or [b" "]


def words(text: str) -> set[bytes]:
    return {w for x in text.encode("utf-8", "surrogatepass").lower().split() if len(w := x.strip(b".,;:!?\"'()[]")) >= 3}


def _lengths(dictionary: bytes, flat: list[bytes]) -> np.ndarray:
    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, min_match=4, write_content_size=False, write_checksum=False, write_dict_id=False)
    held = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    out = zstandard.ZstdCompressor(dict_data=held, compression_params=params).multi_compress_to_buffer(flat, threads=0)
    return np.fromiter((len(out[i]) for i in range(len(flat))), np.int64, len(flat))


def features(model: Model, texts: list[str]) -> np.ndarray:
    """For each text: a constant, the most the toxic dictionary is ahead, how many windows reach each threshold, and how many there are."""
    each = [windows(t) for t in texts]
    flat = [w for x in each for w in x]
    ahead = _lengths(model.ordinary, flat) - _lengths(model.toxic, flat)
    starts = np.cumsum([0, *map(len, each)])[:-1]
    counts = [np.add.reduceat((ahead >= t).astype(np.int64), starts) for t in THRESHOLDS]
    return np.column_stack([np.ones(len(texts)), np.maximum.reduceat(ahead, starts), *map(np.log1p, counts), np.log1p(list(map(len, each)))])


def scores(model: Model, texts: list[str]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    if not model.center:
        return np.full(len(texts), model.weights[0])
    x = (features(model, texts) - model.center) / model.scale
    return 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))


def _toxic_words(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    of = [words(t) for t in toxic]
    here, there = Counter(w for x in of for w in x), Counter(w for t in ordinary for w in words(t))
    telling = {w for w, n in here.items() if n >= LEAST_DOCUMENTS and n / len(toxic) >= TIMES * (there[w] + 0.5) / len(ordinary)}
    taken, left = [], [x & telling for x in of]
    while len(taken) < MOST_WORDS and (counts := Counter(w for x in left for w in x)):
        word, n = max(counts.items(), key=lambda x: (x[1], x[0]))
        if n < 3:
            break
        taken.append(word)
        left = [x for x in left if word not in x]
    frequent = sorted((w for w in telling - set(taken) if here[w] >= FREQUENT * len(toxic)), key=lambda w: (-here[w], w))
    return taken + frequent[:MOST_WORDS]


def fit(rows: list[tuple[str, int]], seed: int = 5) -> Model:
    """The model from (text, label) rows; equal texts count once."""
    rnd = random.Random(seed)
    rows = sorted(dict(rows).items())
    rnd.shuffle(rows)
    toxic, ordinary = [t for t, y in rows if y], [t for t, y in rows if not y]
    if len(toxic) < LEAST_LABELLED or len(ordinary) < LEAST_LABELLED:
        return Model(b"", b"", [(len(toxic) + 1) / (len(rows) + 2) if rows else 0.0], [], [])
    own_toxic, own_ordinary = toxic[len(toxic) // 2 :], ordinary[len(ordinary) // 2 :]
    toxic, ordinary = toxic[: len(toxic) // 2], ordinary[: len(ordinary) // 2]
    sample = [w for t in ordinary for w in windows(t)]
    rnd.shuffle(sample)
    try:
        content = zstandard.train_dictionary(DICTIONARY_BYTES, sample[:MOST_WINDOWS]).as_bytes()
    except zstandard.ZstdError:  # too little text to train on
        content = b"".join(sample)[:DICTIONARY_BYTES]
    telling = b" ".join(_toxic_words(toxic, ordinary))
    model = Model(b" " + content, b" " + telling + b" " + content, [], [1.0], [1.0])
    x = features(model, own_toxic + own_ordinary)
    y = np.array([1.0] * len(own_toxic) + [0.0] * len(own_ordinary))
    center, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    center[0], scale[0] = 0.0, 1.0
    x = (x - center) / scale
    w = np.zeros(x.shape[1])
    for _ in range(3000):
        w -= 0.5 * (x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(y) + 1e-4 * w)
    return model._replace(weights=w.tolist(), center=center.tolist(), scale=scale.tolist())


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Fit on the bounded sample of labelled rows that aren't held out."""
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    usable = usable.groupBy("id").agg(F.max("label").alias("label"))
    order = [F.xxhash64("id"), F.col("id")]
    picked = [usable.filter(F.col("label") == y).orderBy(*order).limit(n) for y, n in ((1, MOST_TOXIC), (0, MOST_ORDINARY))]
    picked = F.broadcast(picked[0].unionByName(picked[1]))  # bounded by the sample's size
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).join(picked, "id").filter(F.length("text") <= MOST_TRAINED)
    rows, chars = [], 0
    for r in texts.orderBy(*order).limit(MOST_TOXIC + MOST_ORDINARY).toLocalIterator():
        chars += len(r["text"])
        if chars > MOST_CHARS:
            break
        rows.append((r["text"], int(r["label"])))
    return fit(rows)


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """docs with the score of each whole text; an existing column of that name is replaced."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(scores(model, texts.tolist()), dtype="float64")

    return docs.withColumn(out_col, run(text_or_empty(text_col)))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    scored = score(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= REJECT).cast("int").alias("predicted"))


def keep_ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that aren't rejected, with their own columns."""
    return score(docs, learn(docs, labels), out_col="__mill_score").filter(F.col("__mill_score") < REJECT).drop("__mill_score")
