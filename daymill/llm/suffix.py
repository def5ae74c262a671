"""Suffix-array deduplication with two-stage sorting.

Texts are UTF-8 bytes. A byte goes if a window of ``WINDOW`` bytes covers it that also starts anywhere else, in the same
text or another one. Windows are judged on the input, overlaps count, and matches never cross texts.

Suffixes are sorted in buckets that hold all windows that may be equal, so that no suffix array spans the corpus and no
text is shipped for each of its suffixes. Each window has an anchor: the place of the smallest hash among its first
``COVER`` places, the leftmost of equals. It depends on the window alone, so equal windows have it at the same place, and
a run of bytes from there lies in all windows of the anchor. The windows of one anchor are neighbours and make a piece.
Pieces are first grouped by the digest of their run, as 8 bytes each; runs that occur once hold no repeated window. Equal
pieces of a group become one piece with a number of occurrences; one text is asked for each, and groups go to buckets
of about ``BUCKET_BYTES`` bytes.

In a bucket, the suffixes smaller than their successors are sorted directly. The others are induced: scanned in order,
each suffix puts the one before it at the head of that one's bucket of first bytes, if it is larger than its successor.
Then neighbours among the windows are compared; windows that agree in ``WINDOW`` bytes are one class, and those of a class
with two or more occurrences are repeated.

A run that a third of all texts share may stand in as many different pieces, where texts differ beside a common passage.
If a group has more than ``MOST`` different pieces, each is cut into pieces of fewer windows, and grouped by the bytes that
all of these share; at last into single windows, which are one piece if equal. So no bucket grows with such a group.

Null: a null text is empty. Rows that repeat a text are as many occurrences, whatever their ids, so their windows are
repeated; repeated and null ids each get their row's result. Texts shorter than a window keep all. An empty table gives an
empty result. Other columns are not read. Texts are told apart by 128 bits of their SHA-256, pieces of one run by 64 bits
of XXH3 beside the run's; windows are compared byte by byte.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import materialise, small_batches, text_or_empty

WINDOW = 400
#: How many windows a piece of a group with too many different pieces has, level by level.
LEVELS = (18, 1)
MOST = 512
BUCKET_BYTES = 1 << 19
#: So many windows of a text are looked at at once.
STRIPE = 1 << 21

_U = np.uint64
_ANCHORS = "key binary, h long, g long, off int, size int, at array<int>"


def cover(window: int) -> int:
    """Among how many of a window's first places its anchor is."""
    return max(1, window * 4 // 5)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _words(text: np.ndarray, length: int) -> np.ndarray:
    """The number that the next bytes are, 8 at most, for each place that has so many."""
    n = len(text) - length + 1
    out = np.zeros(max(n, 0), _U)
    for j in range(length):
        out |= text[j : j + n].astype(_U) << _U(8 * j)
    return out


def anchors(text: np.ndarray, window: int) -> np.ndarray:
    """The anchor of the window that starts at each place; the text isn't shorter than a window."""
    wide = cover(window)
    run = window - wide + 1
    x = _words(text, min(8, run))[: len(text) - run + 1]
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    place = _U((1 << 24) - 1)
    x = (x & ~place) | np.arange(len(x), dtype=_U)
    full = np.full(-(-len(x) // wide) * wide, np.iinfo(_U).max, _U)
    full[: len(x)] = x
    blocks = full.reshape(-1, wide)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(text) - window + 1
    return (np.minimum(onward[:n], upto[wide - 1 : wide - 1 + n]) & place).astype(np.int64)


def pieces(text: bytes, window: int) -> Iterator[tuple[int, int, int]]:
    """(first window, last window, anchor) of each piece of a text."""
    for base in range(0, len(text) - window + 1, STRIPE):
        of = anchors(np.frombuffer(text, np.uint8, min(len(text) - base, STRIPE + window - 1), base), window)
        cuts = np.flatnonzero(np.diff(of)) + 1
        for first, last in zip([0, *cuts.tolist()], [*(cuts - 1).tolist(), len(of) - 1], strict=True):
            yield base + first, base + last, base + int(of[first])


class _Found:
    """Rows (key, h, g, off, size, at), one for each text and different piece."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []

    def add(self, key: bytes, text: bytes, window: int, found: Iterator[tuple[int, int, int]]) -> None:
        run = window - cover(window) + 1
        self._add(key, text, window, ((first, last, at, text[at : at + run], 0) for first, last, at in found))

    def add_parts(self, key: bytes, text: bytes, window: int, width: int, found: list[dict]) -> None:
        """Pieces cut into parts of so many windows, at the same places seen from the anchor."""

        def parts() -> Iterator[tuple]:
            for x in found:
                for start in x["at"]:
                    at, last = start + x["off"], start + x["size"] - window
                    for part in range((at - last) // width, (at - start) // width + 1):
                        right = at - part * width  # the part's last window, wherever the piece ends
                        core = text[right : right - width + 1 + window]
                        yield max(start, right - width + 1), min(last, right), at, core, part + 1

        self._add(key, text, window, parts())

    def _add(self, key: bytes, text: bytes, window: int, found: Iterator[tuple]) -> None:
        own: dict[tuple, list[int]] = {}
        for first, last, at, core, seed in found:
            h = xxhash.xxh3_64_intdigest(core, seed)
            g = xxhash.xxh3_64_intdigest(text[first : last + window], at - first + 1)
            own.setdefault((h, g, at - first, last - first + window), []).append(first)
        self.rows += [(key, _signed(h), _signed(g), off, size, at) for (h, g, off, size), at in own.items()]

    def batch(self) -> pa.RecordBatch:
        columns = [*zip(*self.rows, strict=True)] or [()] * 6
        types = (pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "h", "g", "off", "size", "at"])


def suffixes(text: np.ndarray, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """The places of a text's suffixes in the order of their first ``depth`` bytes at least, by two-stage sorting.

    wanted: which of them are asked for. Others come along only if those that are asked for are induced from them.
    """
    n, raw = len(text), text.tobytes()
    changes = np.flatnonzero(text[1:] != text[:-1])
    next_ = np.searchsorted(changes, np.arange(n))
    smaller = np.append(text[changes] < text[changes + 1], False)[next_]
    direct = np.flatnonzero(smaller)
    if wanted is not None:
        needed = np.unique(np.searchsorted(direct, np.flatnonzero(wanted)))  # the first from each place on
        direct = direct[needed[needed < len(direct)]]
    direct = np.array(sorted(direct.tolist(), key=lambda i: raw[i : i + depth]), np.int64)
    bounds = np.searchsorted(text[direct], np.arange(257))
    heads: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n:
        heads[text[-1]].append(np.array([n - 1]))  # what the empty suffix induces
    out = []
    for byte in range(256):
        wave = np.concatenate([np.zeros(0, np.int64), *heads[byte]])
        while len(wave):
            out.append(wave)
            before = wave[wave > 0] - 1
            heads_on(heads, text, before, byte)
            wave = before[text[before] == byte]
        own = direct[bounds[byte] : bounds[byte + 1]]
        out.append(own)
        heads_on(heads, text, own[own > 0] - 1, byte)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def heads_on(heads: list[list[np.ndarray]], text: np.ndarray, before: np.ndarray, byte: int) -> None:
    """Put suffixes that start with larger bytes at the heads of their buckets, in the order given."""
    before = before[text[before] > byte]
    order = np.argsort(text[before], kind="stable")
    before = before[order]
    first = text[before]
    for part in np.split(before, np.flatnonzero(np.diff(first)) + 1):
        if len(part):
            heads[text[part[0]]].append(part)


def agree(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the next so many bytes from a and from b are the same, pair by pair."""
    step = min(8, length)
    words = _words(text, step)
    offsets = sorted({*range(0, length - step + 1, step), length - step}, reverse=True)  # neighbours differ late
    open_ = np.arange(len(a))
    for o in offsets:
        open_ = open_[words[a[open_] + o] == words[b[open_] + o]]
    out = np.zeros(len(a), bool)
    out[open_] = True
    return out


def runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of marked places."""
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(starts: np.ndarray, lengths: np.ndarray | int, n: int) -> np.ndarray:
    marks = np.bincount(starts, minlength=n + 1) - np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(marks)[:n] > 0


def repeated(parts: list[bytes], times: np.ndarray, window: int) -> list[list[int]]:
    """For each piece the places (start, end, ...) that repeated windows cover; times: how often each piece occurs."""
    text = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
    ends = np.cumsum([len(p) + 1 for p in parts])
    of = np.repeat(np.arange(len(parts)), np.diff(ends, prepend=0))
    wanted = np.arange(len(text)) + window < ends[of]  # where a window starts
    order = suffixes(text, window, wanted)
    order = order[wanted[order]]
    same = agree(text, order[:-1], order[1:], window)
    group = np.concatenate([[0], np.cumsum(~same)])[: len(order)]
    several = np.bincount(group, weights=times[of[order]]) >= 2
    starts, stops = runs(covered(order[several[group]], window, len(text)))
    out: list[list[int]] = [[] for _ in parts]
    for a, b, i in zip(starts.tolist(), stops.tolist(), of[starts].tolist(), strict=True):
        base = int(ends[i]) - len(parts[i]) - 1
        out[i] += [a - base, b - base]
    return out


def _level(found: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """Pieces whose run occurs twice or more, and the groups of equal ones with occurrences, a place, and kinds of the run."""
    twice = found.groupBy("h").agg(F.sum(F.size("at")).alias("n")).filter("n > 1").select("h")
    shared = materialise(found.join(twice, "h"), f"suffix-shared-{level}")
    first = F.min(F.struct("key", F.element_at("at", 1).alias("at"), "size")).alias("x")
    groups = shared.groupBy("h", "g").agg(F.sum(F.size("at")).alias("times"), first).select("h", "g", "times", "x.*")
    groups = materialise(groups, f"suffix-groups-{level}")
    return shared, groups.join(groups.groupBy("h").agg(F.count("*").alias("kinds")), "h")


def _spans(named: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(key, text) of each text that may repeat something, and (key, found) with the spans of its pieces."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _Found()
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.add(key, text, window, pieces(text, window))
            yield found.batch()

    def split(width: int) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = _Found()
                for key, text, own in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                    found.add_parts(key, text, window, width, own)
                yield found.batch()

        return run

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(x["h"], x["g"], x["times"], text[x["at"] : x["at"] + x["size"]]) for text, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for x in own]
            columns = [*zip(*rows, strict=True)] or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["h", "g", "times", "piece"])

    def sort(mine: pd.DataFrame) -> pd.DataFrame:
        mine = mine.drop_duplicates(["h", "g"])  # rows that repeat id and text are asked for the same
        spans = repeated(mine["piece"].tolist(), mine["times"].to_numpy(np.float64), window)
        return pd.DataFrame({"h": mine["h"], "g": mine["g"], "spans": spans})[[bool(s) for s in spans]]

    level, texts, cold = 0, None, []
    found = materialise(named.filter(F.length("text") >= window).select("key", "text").mapInArrow(find, _ANCHORS), "suffix-pieces")
    all_shared = []
    while True:
        shared, groups = _level(found, level)
        if texts is None:
            # one row for each text: rows of one text with other ids are spread over the join and match nothing
            touched = shared.select("key").distinct()
            firsts = named.select("key", "id").join(touched, "key", "left_semi").groupBy("key").agg(F.min("id").alias("id"))
            firsts = firsts.select(F.col("key").alias("of"), F.col("id").alias("first"))
            rows = named.join(firsts, (F.col("key") == F.col("of")) & F.col("id").eqNullSafe(F.col("first")), "left_semi")
            texts = materialise(rows.select("key", "text"), "suffix-texts")
        cold.append(groups.filter(F.col("kinds") <= MOST) if level < len(LEVELS) else groups)
        all_shared.append(shared.select("key", "h", "g", "at"))
        if level == len(LEVELS):
            break
        hot = groups.filter(F.col("kinds") > MOST).select("h").distinct()
        if hot.isEmpty():
            break
        again = shared.join(hot, "h", "left_semi").groupBy("key").agg(F.collect_list(F.struct("off", "size", "at")).alias("own"))
        found = materialise(texts.join(again, "key").select("key", "text", "own").mapInArrow(split(LEVELS[level]), _ANCHORS).dropDuplicates(["key", "h", "g"]), f"suffix-parts-{level}")
        level += 1
    groups = cold[0]
    for more in cold[1:]:
        groups = groups.unionByName(more)
    groups = groups.drop("kinds")
    buckets = (groups.agg(F.sum("size")).first()[0] or 0) // BUCKET_BYTES + 1
    wanted = groups.groupBy("key").agg(F.collect_list(F.struct("h", "g", "times", "at", "size")).alias("own"))
    cuts = texts.join(wanted, "key").select("text", "own").mapInArrow(cut_out, "h long, g long, times long, piece binary")
    bucket = F.pmod(F.xxhash64("h"), F.lit(buckets)).alias("bucket")
    spans = cuts.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(sort, "h long, g long, spans array<int>")
    shared = all_shared[0]
    for more in all_shared[1:]:
        shared = shared.unionByName(more)
    return texts, shared.join(spans, ["h", "g"]).groupBy("key").agg(F.collect_list(F.struct("at", "spans")).alias("own"))


def _removed(text: bytes, own: list[dict]) -> np.ndarray:
    """Which bytes the spans of a text's pieces cover."""
    starts = np.concatenate([np.add.outer(x["at"], x["spans"][::2]).ravel() for x in own])
    ends = np.concatenate([np.add.outer(x["at"], x["spans"][1::2]).ravel() for x in own])
    return covered(starts, ends - starts, len(text))


def _run(docs: DataFrame, id_col: str, text_col: str, window: int, kept: str, render: Callable[[bytes], object], whole: Column) -> DataFrame:
    small_batches(docs.sparkSession, 250, 2)
    text = text_or_empty(text_col)
    key = F.substring(F.unhex(F.sha2(text, 256)), 1, 16)
    named = docs.select(F.col(id_col).alias("id"), key.alias("key"), text.cast("binary").alias("text"))
    texts, spans = _spans(named, window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key_, text_, own in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                gone = _removed(text_, own)
                rows.append((key_, int(gone.sum()), len(runs(gone)[0]), render(np.frombuffer(text_, np.uint8)[~gone].tobytes())))
            columns = [*zip(*rows, strict=True)] or [()] * 4
            types = (pa.binary(), pa.int64(), pa.int64(), pa.string() if kept.endswith("string") else pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["of", "n_removed", "n_spans", "rest"])

    done = texts.join(spans, "key").select("key", "text", "own").mapInArrow(cut, f"of binary, n_removed long, n_spans long, rest {kept.split()[1]}")
    done = done.dropDuplicates(["of"])
    every = named.select("id", "key", F.length("text").cast("long").alias("n_bytes"), whole.alias("whole"))
    count = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    out = every.join(done, F.col("key") == F.col("of"), "left")
    return out.select(F.col("id").alias("doc_id"), "n_bytes", count("n_removed"), count("n_spans"), F.coalesce("rest", "whole").alias(kept.split()[0]))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every row; kept is the bytes that stay, n_spans counts removed runs."""
    return _run(docs, id_col, text_col, window, "kept binary", lambda kept: kept, F.col("text"))


def deduplicate_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """As deduplicate(), with kept_sha256 (lowercase hex) in place of kept."""
    return _run(docs, id_col, text_col, window, "kept_sha256 string", lambda kept: hashlib.sha256(kept).hexdigest(), F.sha2("text", 256))
