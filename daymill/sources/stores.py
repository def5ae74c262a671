"""Files by path inside tasks: local ones, and URIs of the stores that Arrow's file systems open."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow.fs import FileSystem, LocalFileSystem
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: What a task that writes files holds of them at once.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def opened(path: str) -> tuple[FileSystem, str]:
    """The store of a path, and the path inside it. Spark's file: paths are plain ones, whatever stands in them."""
    if path.startswith("file:"):
        return LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return FileSystem.from_uri(path) if ":/" in path else (LocalFileSystem(), path)


def listed(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """(path, length) of the files at or below some paths; Spark lists them, and none is read. Empty files are left out."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return (reader.option("pathGlobFilter", glob) if glob else reader).load(paths).select("path", "length")


def write_files(df: DataFrame, folder: str, name: str = "name", content: str = "content") -> int:
    """Write each row's bytes as a file of its name below a folder that all tasks share; how many were written.

    A task that runs again writes the same files again.
    """

    spark = df.sparkSession
    before = spark.conf.get(BATCH[0], None)
    spark.conf.set(*BATCH)  # else a worker holds 64 MB of files, several times
    try:
        return _written(df, folder, name, content).agg(F.sum("n")).first()[0] or 0
    finally:
        spark.conf.unset(BATCH[0]) if before is None else spark.conf.set(BATCH[0], before)


def _written(df: DataFrame, folder: str, name: str, content: str) -> DataFrame:
    """(n) of each batch that a task writes as files; their bytes aren't copied."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, inside = opened(folder)
        for batch in batches:
            for n, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                at = f"{inside.rstrip('/')}/{n}"
                store.create_dir(at.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(at, compression=None) as f:
                    f.write(data.as_buffer())
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})

    named = df.select(F.col(name).alias("name"), F.col(content).cast("binary").alias("content"))
    return named.mapInArrow(write, "n long")
