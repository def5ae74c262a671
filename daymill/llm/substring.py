"""Substring deduplication with difference-cover anchors.

A window is ``WINDOW`` consecutive words of one document. A word goes if a window covers it whose word sequence also
starts in a document with a smaller id. Hashing every window would make a row for nearly every word. Instead, runs of
``ANCHOR`` words are hashed only at positions whose remainder modulo ``PERIOD`` is in a difference cover: for any two
positions there is a shift below the period that takes both to cover positions, so two equal windows always hold an
equal anchor that both documents hashed. Then it extends: only windows around anchors that several documents share
are compared, by two 64-bit digests of the whole window, which come from different digests of its words.

Three rounds move over the shuffle, each in packed blobs rather than rows: anchors to buckets of their hash; from
there, what is shared, to buckets of documents; their windows to buckets of window digests, and back. Texts are
shuffled by document, never by a shared key, and exact copies within a batch send nothing but their ids.

Nulls: a null text has no words; a row with a null id takes no text from others but may lose its own. Rows that
repeat an id are judged alone, and don't count as smaller than each other. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import NO_ID, materialise, shuffle_width, small_batches, text_or_empty, xxhash64_of_longs

WINDOW = 50
PERIOD = 31
#: A perfect difference set: each shift below the period is the difference of two members.
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1
#: Texts are hashed in pieces of about so many bytes, and anchors are sent on once so many wait.
PIECE_BYTES = 2 << 20
WAITING = 1 << 20

_U = np.uint64
_ODD = (_U(0x9E3779B97F4A7C15), _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of a few texts and digests of runs of them, vectorised; runs never cross from text to text."""

    def __init__(self, texts: list[bytes]) -> None:
        buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        space = (buf == 32) | ((buf >= 9) & (buf <= 13))
        edge = np.diff(space.astype(np.int8), prepend=np.int8(1))
        starts = np.flatnonzero(edge == -1)
        lengths = np.flatnonzero(edge == 1)
        lengths = lengths[len(lengths) - len(starts) :] - starts
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.bounds = np.searchsorted(starts, np.concatenate([[0], ends]))
        self.counts = np.diff(self.bounds)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)
        self.at = np.arange(len(starts)) - self.bounds[self.doc]
        self.left = self.counts[self.doc] - self.at
        first = np.cumsum(lengths) - lengths
        if len(starts):
            # each byte at each place of a word has a number of its own, once for each digest; a word's is their sum
            at = (np.arange(lengths.sum()) - np.repeat(first, lengths)).astype(_U) << _U(8) | buf[~space]
            self.word = tuple(_mix(np.add.reduceat(_mix(at * odd + odd), first) + lengths.astype(_U) * odd) for odd in _ODD[:2])
        else:
            self.word = (np.zeros(0, _U),) * 2

    def runs(self, length: int, which: int = 0) -> np.ndarray:
        """The digest of the run of so many words that starts at each word; wrong where a text ends before."""
        value, base = self.word[which], _ODD[1 + which]
        inverse = _U(pow(int(base), -1, 1 << 64))
        total = np.concatenate([np.zeros(1, _U), np.cumsum(value * _powers(base, len(value)))])
        upto = np.minimum(np.arange(len(value)) + length, len(value))
        return _mix((total[upto] - total[:-1]) * _powers(inverse, len(value)))

    def windows(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two digests, made from different digests of the words, of the windows that start at some words."""
        return self.runs(WINDOW)[at], self.runs(WINDOW, 1)[at]

    def anchors(self) -> np.ndarray:
        """The indices of the words at which an anchor starts."""
        in_cover = np.isin(np.arange(PERIOD), COVER)
        return np.flatnonzero(in_cover[self.at % PERIOD] & (self.left >= ANCHOR) & (self.counts[self.doc] >= WINDOW))

    def windows_around(self, anchors: np.ndarray) -> np.ndarray:
        """The indices of the words at which a window starts that holds one of the anchors."""
        n = len(self.at)
        low = np.maximum(anchors - (WINDOW - ANCHOR), anchors - self.at[anchors])
        high = np.minimum(anchors, self.bounds[self.doc[anchors] + 1] - WINDOW)
        marks = np.bincount(low, minlength=n + 1) - np.bincount(high + 1, minlength=n + 1)[: n + 1]
        return np.flatnonzero(np.cumsum(marks)[:n] > 0)

    def covered(self, windows: np.ndarray) -> np.ndarray:
        """Which words these windows cover."""
        n = len(self.at)
        marks = np.bincount(windows, minlength=n + 1) - np.bincount(windows + WINDOW, minlength=n + 1)[: n + 1]
        return np.cumsum(marks)[:n] > 0


def _pieces(ids: np.ndarray, texts: list[str]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    at, size, held = 0, 0, []
    for i, t in enumerate(texts):
        held.append(t.encode("utf-8", "surrogatepass"))
        size += len(held[-1]) + 1
        if size >= PIECE_BYTES or i == len(texts) - 1:
            yield ids[at : i + 1], held
            at, size, held = i + 1, 0, []


def _blobs(bucket: np.ndarray, **columns: np.ndarray) -> pd.DataFrame:
    """One row for each bucket, with that bucket's part of every column in bytes."""
    bucket = bucket.astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-2))
    out = {"bucket": bucket[cuts]}
    ends = [*cuts[1:], len(bucket)][: len(cuts)]
    for k, v in columns.items():
        v = v[order]
        out[k] = [v[a:b].tobytes() for a, b in zip(cuts, ends, strict=True)]
    return pd.DataFrame(out)


def _joined(blobs: pd.Series, kind) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), kind)


def _of(ids: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Digest of a document and a digest in it."""
    return _mix(xxhash64_of_longs(ids) ^ digests)


def _both(h: np.ndarray, g: np.ndarray) -> np.ndarray:
    """One digest of a window from its two."""
    return _mix(h + _mix(g ^ _ODD[2]))


def _whole(texts: pd.Series) -> np.ndarray:
    """Digests of whole texts."""
    return np.array([xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")) for t in texts], _U)


def _unique(ids: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Indices of one entry for each document and digest."""
    return np.unique(_of(ids, digests), return_index=True)[1]


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; kept is the words that stay, joined by one space."""
    return _run(docs, id_col, text_col, "kept string", lambda kept: kept.decode("utf-8", "surrogatepass"))


def deduplicate_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As deduplicate(), with kept_sha256 (lowercase hex of kept's UTF-8 bytes) in place of kept."""
    return _run(docs, id_col, text_col, "kept_sha256 string", lambda kept: hashlib.sha256(kept).hexdigest())


def _run(docs: DataFrame, id_col: str, text_col: str, kept: str, render) -> DataFrame:
    spark = docs.sparkSession
    small_batches(spark)
    n = shuffle_width(spark)
    named = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), text_or_empty(text_col).alias("text"))
    placed = named.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(n)))

    def send_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes: list[np.ndarray] = []
        owners: list[np.ndarray] = []

        def flush() -> Iterator[pd.DataFrame]:
            if hashes:
                h, d = np.concatenate(hashes), np.concatenate(owners)
                yield _blobs((h >> _U(8)) % _U(n), h=h, d=d)
                hashes.clear()
                owners.clear()

        for batch in batches:
            smallest = batch.groupby("text", sort=False)["id"].transform("min").to_numpy() if len(batch) else np.zeros(0)
            copies = batch["id"].to_numpy() > smallest
            if copies.any():
                d = batch["id"].to_numpy()[copies]
                yield _blobs(np.full(len(d), -1), h=_whole(batch["text"][copies]), d=d)
            own = batch[~copies]
            for ids, texts in _pieces(own["id"].to_numpy(), own["text"].tolist()):
                words = Words(texts)
                at = words.anchors()
                h, d = words.runs(ANCHOR)[at], ids[words.doc[at]]
                one = _unique(d, h)
                hashes.append(h[one])
                owners.append(d[one])
                if sum(map(len, hashes)) >= WAITING:
                    yield from flush()
        yield from flush()

    def find_shared(parts: pd.DataFrame) -> pd.DataFrame:
        h, d = _joined(parts["h"], _U), _joined(parts["d"], np.int64)
        order = np.lexsort((d, h))
        h, d = h[order], d[order]
        group = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        several = np.bincount(group[1:], weights=(d[1:] != d[:-1]) & (group[1:] == group[:-1]), minlength=group[-1] + 1 if len(group) else 0) > 0
        keep = several[group]
        h, d = h[keep], d[keep]
        return _blobs(xxhash64_of_longs(d).view(np.int64) % n, h=h, d=d)

    def send_windows(mine: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
        if not len(mine) or not len(shared):
            return pd.DataFrame({"bucket": [], "h": [], "g": [], "d": []})
        ids, hashes = _joined(shared["d"], np.int64), _joined(shared["h"], _U)
        known = np.unique(_of(ids, hashes))
        mine = mine[np.isin(mine["id"].to_numpy(), ids)].drop_duplicates()
        found: list[tuple[np.ndarray, ...]] = []
        for own, texts in _pieces(mine["id"].to_numpy(), mine["text"].tolist()):
            words = Words(texts)
            at = words.anchors()
            at = at[np.isin(_of(own[words.doc[at]], words.runs(ANCHOR)[at]), known)]
            at = words.windows_around(at)
            (h, g), d = words.windows(at), own[words.doc[at]]
            one = _unique(d, _both(h, g))
            found.append((h[one], g[one], d[one]))
        h, g, d = (np.concatenate(x) for x in zip(*found, strict=True))
        return _blobs((h >> _U(8)) % _U(n), h=h, g=g, d=d)

    def find_repeats(parts: pd.DataFrame) -> pd.DataFrame:
        h, g, d = _joined(parts["h"], _U), _joined(parts["g"], _U), _joined(parts["d"], np.int64)
        order = np.lexsort((d, g, h))
        h, g, d = h[order], g[order], d[order]
        new = np.concatenate([[True], (h[1:] != h[:-1]) | (g[1:] != g[:-1])])[: len(h)]
        later = d > d[np.flatnonzero(new)][np.cumsum(new) - 1] if len(h) else new
        h, d = _both(h[later], g[later]), d[later]
        return _blobs(xxhash64_of_longs(d).view(np.int64) % n, h=h, d=d)

    def cut(mine: pd.DataFrame, repeats: pd.DataFrame) -> pd.DataFrame:
        copies = repeats["copy"].to_numpy(bool)
        copied = _joined(repeats["d"][copies], np.int64)
        wholly = _of(copied, _joined(repeats["h"][copies], _U))
        ids, hashes = _joined(repeats["d"][~copies], np.int64), _joined(repeats["h"][~copies], _U)
        known = np.unique(_of(ids, hashes))
        out: list[tuple] = []
        mine_ids = mine["id"].to_numpy()
        touched, whole = np.isin(mine_ids, ids), np.isin(mine_ids, copied)
        whole[whole] = np.isin(_of(mine_ids[whole], _whole(mine["text"][whole])), wholly)
        texts = mine["text"].tolist()
        for i in np.flatnonzero(~touched | whole):
            words = texts[i].encode("utf-8", "surrogatepass").split()
            gone = len(words) if whole[i] and len(words) >= WINDOW else 0
            out.append((mine_ids[i], len(words), gone, render(b" ".join(words[gone:]))))
        rest = np.flatnonzero(touched & ~whole)
        for own, part in _pieces(mine_ids[rest], [texts[i] for i in rest]):
            words = Words(part)
            at = np.flatnonzero(words.left >= WINDOW)
            at = at[np.isin(_of(own[words.doc[at]], _both(*words.windows(at))), known)]
            stays = ~words.covered(at)
            for k, t in enumerate(part):
                own_stays = stays[words.bounds[k] : words.bounds[k + 1]]
                out.append((own[k], len(own_stays), int((~own_stays).sum()), render(b" ".join(w for w, s in zip(t.split(), own_stays, strict=True) if s))))
        return pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", kept.split()[0]])

    anchors = materialise(named.mapInPandas(send_anchors, "bucket long, h binary, d binary"), "anchors")
    shared = anchors.filter("bucket >= 0").groupBy("bucket").applyInPandas(find_shared, "bucket long, h binary, d binary")
    windows = placed.groupBy("bucket").cogroup(shared.groupBy("bucket")).applyInPandas(send_windows, "bucket long, h binary, g binary, d binary")
    repeats = windows.groupBy("bucket").applyInPandas(find_repeats, "bucket long, h binary, d binary").withColumn("copy", F.lit(False))
    copies = anchors.filter("bucket < 0").mapInPandas(_to_documents(n), "bucket long, h binary, d binary").withColumn("copy", F.lit(True))
    done = placed.groupBy("bucket").cogroup(repeats.unionByName(copies).groupBy("bucket")).applyInPandas(cut, f"doc_id long, n_words long, n_removed long, {kept}")
    return done.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def _to_documents(n: int):
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            d, h = _joined(x["d"], np.int64), _joined(x["h"], _U)
            yield _blobs(xxhash64_of_longs(d).view(np.int64) % n, h=h, d=d)

    return send
