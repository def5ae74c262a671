"""Writing whole days, what was written, views, exports and bounded results."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.stores import listed, opened
from .nested import assert_same_count


def to_contract(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The contract's columns in order and type; a missing one is an error, others are left out."""
    if missing := [n for n in schema.names if n not in df.columns]:
        raise ValueError(f"column {missing[0]} is missing")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


#: A task writes about so many rows of a day.
ROWS = 250_000


def files_for(rows: int, days: int) -> int:
    """How many files a day is split over, so that what a task writes doesn't grow with the days."""
    return 1 + rows // (max(1, days) * ROWS)


def write_days(df: DataFrame, path: str, schema: T.StructType, day: str, keys: list[str], days: list[datetime.date] | None = None, files: int = 1) -> None:
    """Replace whole days of a table, rows in key order, by dynamic partition overwrite.

    days: those that this call is about; each of them without rows is emptied. files: how many a day is split over,
    for days too large for one task (by ranges of the first key).
    """
    held = {d: _files(df.sparkSession, f"{path}/{day}={d.isoformat()}") for d in set(days or ())}
    rows = to_contract(df, schema)
    placed = rows.repartition(day) if files == 1 else rows.repartition(day, F.pmod(F.xxhash64(keys[0]), F.lit(files)))
    written = placed.sortWithinPartitions(day, *[F.col(k).asc_nulls_first() for k in keys])
    written.write.partitionBy(day).mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(path)
    for d, names in held.items():  # a day that got rows has other files now
        folder = f"{path}/{day}={d.isoformat()}"
        if names and _files(df.sparkSession, folder) == names:
            store, at = _store(df.sparkSession, folder)
            store.delete(at, True)


def _store(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _files(spark: SparkSession, path: str) -> set[str]:
    """The names of the files in a day's folder; none if it isn't there."""
    store, at = _store(spark, path)
    return {f.getPath().getName() for f in store.listStatus(at)} if store.exists(at) else set()


def stage_counted(documents: DataFrame, parse: Callable[[DataFrame], DataFrame], path: str) -> tuple[DataFrame, int]:
    """The rows that parse() makes of documents, written to a staging folder, and how many they are: one for each document.

    Both are counted inside the one job that writes. If a document gave no row, or a row came from nowhere, it fails before
    any day is published from the staging folder.
    """
    read, made = Observation(), Observation()
    one = F.count(F.lit(1)).alias("n")
    rows = parse(documents.observe(read, one)).observe(made, one)
    rows.write.parquet(path)
    assert_same_count(made.get["n"], read.get["n"])
    return documents.sparkSession.read.schema(rows.schema).parquet(path), made.get["n"]


def manifest_rows(stats: DataFrame, table: str, day: str, dataset: str, revision: int, parser_version: int, built: DataFrame | None = None, unknown: DataFrame | None = None, hashes: DataFrame | None = None) -> DataFrame:
    """(table_name, day, n_rows, dataset, object_key, revision, sha256, parser_version, written_at, unknown_keys, built_from)
    of each day written; append these.

    stats: (day, n_rows) of the table, as partition_stats() reads them from its footers.
    built: (day, built_from) of merged days; unknown: (day, unknown_keys array) where documents drifted; hashes: (day,
    sha256) of the files that days came from. Days that they lack get null, and no unknown keys.
    """
    out = stats.select(day, "n_rows")
    for name, kind, given in (("built_from", "string", built), ("unknown_keys", "array<string>", unknown), ("sha256", "string", hashes)):
        out = out.withColumn(name, F.lit(None).cast(kind)) if given is None else out.join(given.select(day, name), day, "left")
    key = F.concat(F.date_format(day, "yyyy"), F.lit("/"), F.col(day).cast("string"))
    return out.select(F.lit(table).alias("table_name"), day, "n_rows", F.lit(dataset).alias("dataset"), key.alias("object_key"), F.lit(revision).alias("revision"), "sha256", F.lit(parser_version).alias("parser_version"), F.current_timestamp().alias("written_at"), F.coalesce("unknown_keys", F.expr("CAST(array() AS array<string>)")).alias("unknown_keys"), "built_from")


def partition_stats(spark: SparkSession, path: str, day: str) -> DataFrame:
    """(day, n_files, n_rows) of a written table, from the footers of its files; no data page is read."""

    def footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for p in batch["path"]:
                store, inside = opened(p)
                with store.open_input_file(inside) as f:
                    rows.append(pq.read_metadata(f).num_rows)
            yield pd.DataFrame({"path": batch["path"], "n": rows})

    counts = listed(spark, path, "*.parquet").select("path").mapInPandas(footers, "path string, n long")
    of = F.to_date(F.regexp_extract("path", f"/{day}=([^/]+)/[^/]*$", 1)).alias(day)
    return counts.groupBy(of).agg(F.count("*").alias("n_files"), F.sum("n").alias("n_rows"))


def register_views(spark: SparkSession, tables: dict[str, tuple[str | None, T.StructType]]) -> None:
    """A view of each table; one without data is an empty relation of its schema."""
    for name, (path, schema) in tables.items():
        df = spark.read.schema(schema).parquet(path).select(*schema.names) if path else spark.createDataFrame([], schema)
        df.createOrReplaceTempView(name)


def export_table(df: DataFrame, path: str, keys: list[str], files: int | None = None) -> DataFrame:
    """Write a table as one snapshot ordered by key, to a new folder; (n_files, n_rows)."""
    placed = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    placed.sortWithinPartitions(*keys).write.mode("errorifexists").option("compression", "zstd").parquet(path)
    back = df.sparkSession.read.parquet(path).select(F.col("_metadata.file_path").alias("f"))
    return back.agg(F.countDistinct("f").alias("n_files"), F.count("*").alias("n_rows"))


def to_arrow(df: DataFrame, rows: int = 65_536) -> list[pa.RecordBatch]:
    """A bounded result as Arrow batches of at most so many rows."""
    return df.toArrow().to_batches(max_chunksize=rows)


def to_rows(df: DataFrame, most: int = 100_000) -> dict:
    """A bounded result as row objects, with columns and row count; a larger one is an error."""
    rows = [r.asDict(recursive=True) for r in df.limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    return {"columns": df.columns, "row_count": len(rows), "rows": rows}
