"""Top-level JSON arrays of any layout, one large file read by many tasks.

Spark splits the text at closing braces, so a file's blocks go to tasks and no brace is lost at a border. Whether a block
starts inside a string, and how deep, depends on all before it. So a first scan gives, for each block and for both
guesses (outside a string, inside one), the parity of its quotes, its change of depth and its least depth; running sums
over a file's blocks then fix every block's true state. Known these, a second scan cuts the records where the depth
returns to 1. A record that crosses borders comes as pieces, which a small shuffle puts together.

The blocks' states go through the driver, one row for each block, as Spark's own list of splits does. All blocks are
scanned in one job. Only the states of files of several blocks go out to tasks: a file that is one block starts outside.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BRACE = b"}"
#: About so much text is looked at at once: its places take many times its bytes.
RUN = 1 << 20
_STATES = "path string, start long, odd boolean, outside_change long, outside_least long, inside_change long, inside_least long"
_PIECES = "path string, opened long, start long, whole boolean, value string"
#: JSON's white space and the comma between records.
_BETWEEN = np.isin(np.arange(256), [9, 10, 13, 32, 44])


@dataclasses.dataclass(frozen=True)
class State:
    """What is true where a block starts: inside a string or not, the depth, and the block where the open record began."""

    inside: bool
    depth: int
    opened: int
    last: bool


#: The state of a file's only block.
ALONE = State(False, 0, -1, True)


def structure(text: np.ndarray, inside: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """(change of depth by each byte, depth after it less the depth before all, number of quotes) from a start not amid an escape."""
    slash = text == 92
    place = np.arange(len(text))
    before = np.concatenate([[-1], np.maximum.accumulate(np.where(slash, -1, place))[:-1]]) if len(text) else place
    escaped = (place - 1 - before) % 2 == 1
    quotes = (text == 34) & ~escaped
    outside = (np.cumsum(quotes) + inside) % 2 == 0
    step = np.where(outside, ((text == 123) | (text == 91)).astype(np.int64) - ((text == 125) | (text == 93)), 0)
    return step, np.cumsum(step), int(quotes.sum())


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes, bool]]:
    """(path, start, text, whether the block ends) of runs of fragments; each fragment but a block's last has its brace again.

    A block's last fragment comes alone, without the brace: it has none if it is the last of its file.
    """
    held: tuple[str, int, bytes] | None = None
    for batch in batches:
        own: list[bytes] = []
        size = 0
        for path, start, value in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if held:
                if held[:2] == (path, start):
                    own.append(held[2] + BRACE)
                    size += len(own[-1])
                    if size >= RUN:
                        yield (*held[:2], b"".join(own), False)
                        own, size = [], 0
                else:
                    if own:
                        yield (*held[:2], b"".join(own), False)
                    own, size = [], 0
                    yield (*held, True)
            held = (path, start, value)
        if own:
            yield (*held[:2], b"".join(own), False)
    if held:
        yield (*held, True)


def _scan_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block; its last fragment counts with its brace, as only a file's last block lacks it."""
    change, least, odd, rows = [0, 0], [0, 0], False, []
    for path, start, text, ends in _blocks(batches):
        part = np.frombuffer(text + BRACE if ends else text, np.uint8)
        for guess in (0, 1):
            _, depth, quotes = structure(part, odd != bool(guess))
            least[guess] = min(least[guess], change[guess] + int(depth.min(initial=0)))
            change[guess] += int(depth[-1]) if len(depth) else 0
        odd ^= bool(quotes % 2)
        if ends:
            rows.append((path, start, odd, change[0], least[0], change[1], least[1]))
            change, least, odd = [0, 0], [0, 0], False
    columns = [*zip(*rows, strict=True)] or [()] * 7
    types = (pa.string(), pa.int64(), pa.bool_(), *[pa.int64()] * 4)
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["path", "start", "odd", "outside_change", "outside_least", "inside_change", "inside_least"])


def block_states(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, int], State]:
    """The state at the start of each block of the files."""
    rows: dict[str, list] = {}
    for r in _fragments(spark, path).mapInArrow(_scan_states, _STATES).collect():
        rows.setdefault(r["path"], []).append(r)
    states = {}
    for name, blocks in rows.items():
        inside, depth, opened = False, 0, -1
        blocks.sort(key=lambda r: r["start"])
        for r in blocks:
            states[name, r["start"]] = State(inside, depth, opened, r is blocks[-1])
            guess = "inside" if inside else "outside"
            if depth + r[f"{guess}_least"] <= 1:  # whatever is open at the end began here
                opened = r["start"]
            depth += r[f"{guess}_change"]
            inside ^= r["odd"]
    return states


def _fragments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    # The bytes of the text; a block's fragments come in their order.
    return spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))


def _cut(text: np.ndarray, state: State, path: str) -> tuple[list[tuple[int, int]], State]:
    """(start, end) of the records of a text, of which the first may have begun before and the last may go on."""
    step, change, quotes = structure(text, state.inside)
    depth = state.depth + change
    starts = np.flatnonzero((step > 0) & (depth == 2))
    ends = np.flatnonzero((step < 0) & (depth == 1)) + 1
    within = np.zeros(len(text) + 1, np.int64)
    if state.depth >= 2:
        starts = np.concatenate([[0], starts])
    if len(text) and depth[-1] >= 2:
        ends = np.concatenate([ends, [len(text)]])
    if len(starts) != len(ends) or (depth < 0).any():
        raise ValueError(f"{path} is no array of records: brackets don't match")
    np.add.at(within, starts, 1)
    np.add.at(within, ends, -1)
    # outside records there is white space, commas, and the array's own brackets at the depth 0
    alone = text[np.cumsum(within[:-1]) == 0]
    if not (_BETWEEN[alone] | (alone == 91) | (alone == 93)).all():
        raise ValueError(f"{path} is no array of records: there is {alone[~_BETWEEN[alone]][:20].tobytes()!r} between them")
    after = State(state.inside ^ bool(quotes % 2), int(depth[-1]) if len(depth) else state.depth, state.opened, state.last)
    return [*zip(starts.tolist(), ends.tolist(), strict=True)], after


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(path, value): the text of each record of top-level arrays, in any layout; a file is read by a task for each block.

    Records are objects. Anything else between them, or brackets that don't match, fails the job. Files are read once for
    the states of blocks, once for whole records and once for those that cross borders.
    """
    states = block_states(spark, path)
    unclosed = [name for (name, _), s in states.items() if s.last and (s.depth < 0 or s.depth == 0 and s.opened >= 0)]
    if unclosed:
        raise ValueError(f"{unclosed[0]} is no array of records: it goes on after its end")
    states = {at: s for at, s in states.items() if s != ALONE}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[str, int] | None = None
        state, held, rows = None, [], []

        def add(value: list[bytes], opened: int, whole: bool) -> None:
            rows.append((at[0], opened, at[1], whole, b"".join(value).decode()))

        for name, start, text, ends in _blocks(batches):
            if at != (name, start):
                at, held = (name, start), []
                state = states.get(at, ALONE)
                opened = state.opened if state.depth >= 2 else -1
            if ends and not state.last:
                text += BRACE
            records, after = _cut(np.frombuffer(text, np.uint8), state, name)
            for i, (a, b) in enumerate(records):
                held.append(text[a:b])
                if i < len(records) - 1 or after.depth < 2:
                    add(held, opened, opened < 0)
                    held, opened = [], -1
            state = after
            if ends and held:
                if state.last:
                    raise ValueError(f"{name} is no array of records: it ends inside one")
                add(held, start if opened < 0 else opened, False)
                held = []
            if ends and state.last and (state.inside or state.depth):
                raise ValueError(f"{name} is no array of records: it has no end")
            columns = [*zip(*rows, strict=True)] or [()] * 5
            types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["path", "opened", "start", "whole", "value"])
            rows.clear()

    pieces = _fragments(spark, path).mapInArrow(cut, _PIECES)
    parts = pieces.filter("NOT whole").groupBy("path", "opened").agg(F.array_sort(F.collect_list(F.struct("start", "value"))).alias("p"))
    joined = parts.select("path", F.array_join(F.transform("p", lambda x: x["value"]), "").alias("value"))
    return pieces.filter("whole").select("path", "value").unionByName(joined)


def read_json_array(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """The records of top-level JSON arrays in any layout, by a fixed schema; a record that doesn't parse fails the job."""
    return read_records(spark, path).select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def write_arrays(records: DataFrame, path: str, files: int) -> None:
    """Write JSON texts, the only column of records, as top-level arrays: so many files, each by a task of its own."""

    def enclose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = lambda lines: pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], names=["value"])
        yield of(["["])
        held: list[str] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                held += batch.column(0).slice(at, 500).to_pylist()
                yield of([f"  {r}," for r in held[:-1]])
                del held[:-1]
        yield of([*(f"  {r}" for r in held), "]"])

    records.repartition(files).mapInArrow(enclose, "value string").write.text(path)
