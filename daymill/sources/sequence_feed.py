"""A feed as a streaming data source whose offset is the sequence.

Feed objects are landed as lines of JSON in folders of ranges, ``range=<k>`` for the sequences from k x width on. A batch
reads the ranges between two sequences, one task each; a range has at most ``width`` sequences, so a task is bounded. The
stream's checkpoint holds the sequence, so a restart goes on after the last one that was read. Within a range each
sequence is given once, from the file whose name comes first; damaged lines and objects without a whole sequence are
passed over. An object that lands below a sequence that was read already is not read: the upstream numbers objects as it
publishes them, and gaps are watched by ``streaming.gaps``.

Paths are local or URIs of a store that Arrow's file systems open.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyarrow import RecordBatch, array, int64, string
from pyarrow.fs import FileSelector, FileType
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from .stores import opened

SCHEMA = "sequence long, value string"
WIDTH = 1 << 16
BATCH = 4096


class Range(InputPartition):
    """The sequences of one folder after ``after`` and up to ``upto``."""

    def __init__(self, k: int, after: int, upto: int) -> None:
        self.k, self.after, self.upto = k, after, upto


class SequenceReader(DataSourceStreamReader):
    def __init__(self, options: dict) -> None:
        self.path, self.width = options["path"].rstrip("/"), int(options.get("width", WIDTH))
        self.name, self.after = options.get("sequence", "sequence_id"), int(options.get("after", -1))

    def _ranges(self) -> list[int]:
        store, inside = opened(self.path)
        found = (re.fullmatch(r"range=(\d+)", f.base_name) for f in store.get_file_info(FileSelector(inside, allow_not_found=True)) if f.type == FileType.Directory)
        return sorted(int(m[1]) for m in found if m)

    def _objects(self, k: int) -> Iterator[tuple[int, str]]:
        """(sequence, line) of a range's files in the order of their names."""
        store, inside = opened(f"{self.path}/range={k}")
        files = [f for f in store.get_file_info(FileSelector(inside, recursive=True)) if f.type == FileType.File and not f.base_name.startswith(("_", "."))]
        for f in sorted(files, key=lambda f: f.path):
            with store.open_input_stream(f.path, compression="detect") as lines:
                rest = b""
                while part := lines.read(1 << 20):
                    *whole, rest = (rest + part).split(b"\n")
                    yield from self._parsed(whole)
                yield from self._parsed([rest])

    def _parsed(self, lines: list[bytes]) -> Iterator[tuple[int, str]]:
        for line in lines:
            try:
                text = line.decode()
                sequence = json.loads(text)[self.name]
            except (ValueError, TypeError, KeyError):
                continue
            if type(sequence) is int:
                yield sequence, text

    def initialOffset(self) -> dict:
        return {"sequence": self.after}

    def latestOffset(self) -> dict:
        """The highest sequence that has landed; reads the last range that has any."""
        for k in reversed(self._ranges()):
            if (newest := max((s for s, _ in self._objects(k)), default=None)) is not None:
                return {"sequence": max(newest, self.after)}
        return self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[Range]:
        after, upto = start["sequence"], end["sequence"]
        return [Range(k, after, upto) for k in self._ranges() if k * self.width <= upto and (k + 1) * self.width > after + 1]

    def read(self, partition: Range) -> Iterator[RecordBatch]:
        seen: set[int] = set()
        held: list[tuple[int, str]] = []
        for sequence, line in self._objects(partition.k):
            if sequence // self.width != partition.k:
                raise ValueError(f"sequence {sequence} stands in range {partition.k}")
            if partition.after < sequence <= partition.upto and sequence not in seen:
                seen.add(sequence)
                held.append((sequence, line))
            if len(held) >= BATCH:
                yield self._batch(held)
                held = []
        yield self._batch(held)

    def _batch(self, rows: list[tuple[int, str]]) -> RecordBatch:
        return RecordBatch.from_arrays([array([s for s, _ in rows], int64()), array([v for _, v in rows], string())], names=["sequence", "value"])

    def commit(self, end: dict) -> None:
        """Landed files stay."""


class SequenceFeed(DataSource):
    """Format ``sequence_feed``; options: path, width, sequence (the field's name), after (the first sequence to leave out)."""

    @classmethod
    def name(cls) -> str:
        return "sequence_feed"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> SequenceReader:
        return SequenceReader(self.options)


def read_sequences(spark: SparkSession, path: str, width: int = WIDTH, after: int = -1, sequence: str = "sequence_id") -> DataFrame:
    """A stream of (sequence, value) over landed feed objects."""
    spark.dataSource.register(SequenceFeed)
    return spark.readStream.format("sequence_feed").option("width", width).option("after", after).option("sequence", sequence).load(path)


def land(objects: DataFrame, path: str, width: int = WIDTH, sequence: str = "sequence_id", column: str = "value") -> None:
    """Append feed objects (JSON text) to the folders of their ranges; those without a whole sequence go nowhere."""
    k = F.expr(f"try_cast(get_json_object(`{column}`, '$.{sequence}') AS bigint) div {width}")
    placed = objects.select(F.col(column).alias("value"), k.alias("range")).filter("range IS NOT NULL")
    placed.repartition("range").write.mode("append").partitionBy("range").text(path)
