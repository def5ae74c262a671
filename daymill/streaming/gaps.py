"""Gaps of a feed's sequence as a stream: told when they are old enough, withdrawn if an object comes after all.

Each task first collapses its part of a micro-batch into runs of consecutive sequences, so what is shuffled grows with the
gaps and not with the objects. A feed is cut into ranges of ``width`` sequences, each a state of its own: its runs and the
gaps that were told inside it. Gaps between the last object of a range and the first of the next one that has any are told
by one more state of the feed, which holds one row a range. So a micro-batch reads and writes the ranges that it touches,
in parallel, and no state grows with the feed but that of one row a range. A gap is told once the object after it is older
than ``age_s`` by the stream's watermark; a timer is set for the next one. Objects are never dropped for being late: the
watermark moves the timers only. Replayed objects change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

TOLD = "feed string, after long, before long, missing long, withdrawn boolean"
_RUNS = "feed string, of_ranges boolean, range long, first long, last long, at_ms long"
_STATE = "first array<bigint>, last array<bigint>, at_ms array<bigint>, told_after array<bigint>, told_before array<bigint>"
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: How many sequences share a state.
WIDTH = 1 << 16


def runs(sequence: np.ndarray, at: np.ndarray, width: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, at): runs of consecutive sequences and the earliest time of each one's first object; with a width, none goes over the end of a range."""
    order = np.lexsort((at, sequence))
    sequence, at = sequence[order], at[order]
    new = np.r_[True, np.diff(sequence) > 1][: len(sequence)]
    if width:
        new[1:] |= np.diff(sequence // width) != 0
    starts = np.flatnonzero(new)
    return sequence[starts], sequence[np.r_[starts[1:], len(sequence)] - 1][: len(starts)], at[starts]


def joined(first: np.ndarray, last: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs that overlap or touch become one, with the earliest time of the first object."""
    order = np.lexsort((at, first))
    first, last, at = first[order], last[order], at[order]
    reach = np.maximum.accumulate(last)
    starts = np.flatnonzero(np.r_[True, first[1:] > reach[:-1] + 1][: len(first)])
    return first[starts], reach[np.r_[starts[1:], len(first)] - 1][: len(starts)], at[starts]


def ends(first: np.ndarray, last: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last, at) of each range: its first and last object, and the earliest time of the first."""
    order = np.lexsort((at, first))
    first, last, at = first[order], last[order], at[order]
    starts = np.flatnonzero(np.r_[True, np.diff(first // width) != 0][: len(first)])
    return first[starts], np.maximum.reduceat(last, starts) if len(first) else last, at[starts]


class Gaps(StatefulProcessor):
    """The runs and told gaps of one range of a feed, or the ends of all its ranges and the gaps told between them."""

    def __init__(self, age_s: int, width: int = WIDTH) -> None:
        self.age_ms, self.width = age_s * 1000, width

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.held = handle, handle.getValueState("runs", _STATE)

    def _state(self) -> tuple[np.ndarray, ...]:
        held = self.held.get() if self.held.exists() else ([],) * 5
        return tuple(np.array(x, np.int64) for x in held)

    def _tell(self, key: tuple, state: tuple[np.ndarray, ...], now_ms: int) -> Iterator[pd.DataFrame]:
        first, last, at, told_after, told_before = state
        gaps = {(a, b): t for a, b, t in zip(last[:-1].tolist(), first[1:].tolist(), at[1:].tolist(), strict=True) if b - a > 1}
        told = [*zip(told_after.tolist(), told_before.tolist(), strict=True)]
        gone, stay = [g for g in told if g not in gaps], [g for g in told if g in gaps]
        known = set(stay)
        waiting = {g: t + self.age_ms for g, t in gaps.items() if g not in known}
        due = [g for g, t in waiting.items() if t <= now_ms]
        self.held.update((first.tolist(), last.tolist(), at.tolist(), *([x[i] for x in stay + due] for i in (0, 1))))
        later = [t for t in waiting.values() if t > now_ms]
        if later:
            self.handle.registerTimer(min(later))
        rows = [(key[0], a, b, b - a - 1, withdrawn) for withdrawn, some in ((True, gone), (False, due)) for a, b in some]
        if rows:
            yield pd.DataFrame(rows, columns=["feed", "after", "before", "missing", "withdrawn"])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first, last, at, *told = self._state()
        came = pd.concat(rows)
        new = [np.concatenate([a, came[c].to_numpy(np.int64)]) for a, c in ((first, "first"), (last, "last"), (at, "at_ms"))]
        held = ends(*new, self.width) if key[1] else joined(*new)
        yield from self._tell(key, (*held, *told), timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._tell(key, self._state(), max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()))


def gap_stream(objects: DataFrame, sequence: str, at: str, age_s: int = 120, feed: str | None = None, width: int = WIDTH) -> DataFrame:
    """A stream of (feed, after, before, missing, withdrawn) over a stream of objects with a sequence and a time.

    feed names the column by which several feeds are told apart; without it all objects are one feed. Objects without a
    sequence or a time are passed over. width: how many sequences share a state; a checkpoint goes with its width. The
    state is kept by RocksDB: see start().
    """
    named = objects.select((F.col(feed).cast("string") if feed else F.lit("")).alias("feed"), F.col(sequence).cast("long").alias("s"), F.col(at).cast("timestamp").alias("t"))
    named = named.filter(F.col("s").isNotNull() & F.col("t").isNotNull()).withWatermark("t", "0 seconds")

    def collapse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, mine in batch.groupby("feed", sort=False, dropna=False):
                inner = runs(mine["s"].to_numpy(np.int64), mine["t_ms"].to_numpy(np.int64), width)
                for of_ranges, (first, last, at_ms) in ((False, inner), (True, ends(*inner, width))):
                    of = 0 if of_ranges else first // width
                    yield pd.DataFrame({"feed": None if pd.isna(name) else name, "of_ranges": of_ranges, "range": of, "first": first, "last": last, "at_ms": at_ms})

    # without the time itself among its columns, so that no late row is filtered out
    collapsed = named.select("feed", "s", F.unix_millis("t").alias("t_ms")).mapInPandas(collapse, _RUNS)
    return collapsed.groupBy("feed", "of_ranges", "range").transformWithStateInPandas(Gaps(age_s, width), TOLD, "Append", "EventTime")


def start(gaps: DataFrame, path: str, checkpoint: str, every: str | None = "30 seconds"):
    """Start writing a gap stream to a table; every None runs over what is there and stops."""
    spark = gaps.sparkSession
    before = spark.conf.get(PROVIDER[0], None)
    spark.conf.set(*PROVIDER)
    try:
        writer = gaps.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
        return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()
    finally:
        spark.conf.unset(PROVIDER[0]) if before is None else spark.conf.set(PROVIDER[0], before)


def open_gaps(told: DataFrame) -> DataFrame:
    """(feed, after, before, missing) of the gaps that were told and not withdrawn."""
    sign = F.when(F.col("withdrawn"), -1).otherwise(1)
    return told.groupBy("feed", "after", "before", "missing").agg(F.sum(sign).alias("__n")).filter("__n > 0").drop("__n")
