"""CSV days by header name, JSON maps and arrays of a record a line, documents, ranges of daily tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .stores import listed, opened


def headers(spark: SparkSession, paths: str | list[str], piece: int = 4096) -> DataFrame:
    """(path, header, n_read): the first line of each file, and how many of its bytes were asked for to find it.

    Compressed files (by their names: bz2, gz, zst, lz4) are read through their codec.
    """

    def first(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                store, inside = opened(path)
                with store.open_input_stream(inside, compression="detect", buffer_size=0) as f:
                    line = b""
                    while b"\n" not in line and (more := f.read(piece)):
                        line += more
                rows.append((path, line.split(b"\n", 1)[0].decode().removeprefix("\ufeff").rstrip("\r"), len(line)))
            yield pd.DataFrame(rows, columns=["path", "header", "n_read"])

    return listed(spark, paths).select("path").mapInPandas(first, "path string, header string, n_read long")


def read_daily_csv(spark: SparkSession, paths: str | list[str], types: Mapping[str, str], optional: Iterable[str] = ()) -> DataFrame:
    """The columns of types, bound by each file's header; optional ones may be absent (then null).

    Headers are read by tasks over the paths, which open each file, compressed ones too, and stop at the first line end; so
    what they read grows with the number of files only. Files with the same header are read together. A header with
    another column, without a required one, or with a name twice is an error.
    """
    heads = headers(spark, paths)
    # One row for each different header (there are a few) and the paths that have it.
    groups = heads.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    optional, parts = set(optional), []
    for g in sorted(groups, key=lambda r: r["header"]):
        names = g["header"].strip().split(",")
        if len(set(names)) < len(names) or set(names) - set(types) or (set(types) - optional) - set(names):
            raise ValueError(f"unknown header {g['header']!r} in {g['paths'][0]}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        part = spark.read.schema(schema).csv(list(g["paths"]), header=True, enforceSchema=False)
        parts.append(part.select(*[(F.nullif(F.col(n), F.lit("")) if n in names else F.lit(None)).cast(types[n]).alias(n) for n in types]))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{n}` {t}" for n, t in types.items()))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_json_map(spark: SparkSession, paths: str | list[str], index_paths: str | list[str] | None = None, day: str = r"(\d{4}-?\d{2}-?\d{2})") -> DataFrame:
    """(path, id, doc, hash): each file is one object of id and document; values that are no objects are skipped.

    The index holds id and hash, and belongs to the documents of its day, which both have in their paths (the last match
    of a pattern); without one, hashes are null. A file that is no JSON object fails the job.
    """
    def entries(where: str | list[str]) -> DataFrame:
        files = spark.read.text(where, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
        whole = F.when(F.ltrim("value").startswith("{"), F.from_json("value", "map<string,string>", {"mode": "FAILFAST"})).otherwise(F.raise_error(F.concat("path", F.lit(" is no JSON object"))).cast("map<string,string>"))
        return files.select("path", F.try_element_at(F.regexp_extract_all("path", F.lit(day), F.lit(1)), F.lit(-1)).alias("d"), F.explode(whole).alias("id", "doc"))

    docs = entries(paths).filter(F.ltrim("doc").startswith("{"))
    if index_paths is None:
        return docs.select("path", "id", "doc", F.lit(None).cast("string").alias("hash"))
    plain = lambda c: F.regexp_replace(c, "-", "")
    index = entries(index_paths).select(plain("d").alias("index_day"), F.col("id").alias("index_id"), F.col("doc").alias("hash"))
    return docs.join(index, (plain("d") == F.col("index_day")) & (F.col("id") == F.col("index_id")), "left").select("path", "id", "doc", "hash")


def parse_documents(df: DataFrame, schema: str | T.StructType, column: str = "doc", mode: str = "FAILFAST") -> DataFrame:
    """df with the parsed document in place of its text; malformed text fails the job."""
    return df.withColumn(column, F.from_json(column, schema, {"mode": mode}))


def read_json_array_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """The records of a JSON array that has one record a line; files are split between tasks."""
    line = F.trim(F.col("value"))
    bare = F.regexp_replace(F.regexp_replace(line, r"^\[\s*", ""), r"\s*,?\s*\]?$", "")
    lines = spark.read.text(path).select(bare.alias("value")).filter("value <> '' AND value <> ']'")
    return lines.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def read_table(spark: SparkSession, path: str, schema: T.StructType, day: str, date_from=None, date_to=None, columns: list[str] | None = None, ordered: bool = False) -> DataFrame:
    """A range of a daily table, both days inclusive, in the contract's column order; ordered by day if asked for.

    Order costs a range shuffle, so it is for a client's edge and not for reads that go on to be aggregated or joined.

    An unknown column is an error; a table that was never written is empty.
    """
    if unknown := [c for c in columns or [] if c not in schema.names]:
        raise ValueError(f"unknown column {unknown[0]}")
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    exists = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there)
    df = spark.read.schema(schema).parquet(path) if exists else spark.createDataFrame([], schema)
    if date_from is not None:
        df = df.filter(F.col(day) >= F.lit(date_from).cast("date"))
    if date_to is not None:
        df = df.filter(F.col(day) <= F.lit(date_to).cast("date"))
    return (df.orderBy(day) if ordered else df).select(*(columns or schema.names))


def read_feed(df: DataFrame, schema: str, column: str = "value", sequence: str = "sequence_id") -> DataFrame:
    """Feed objects from lines, batch or stream; damaged lines and objects without a whole sequence are dropped."""
    parsed = df.withColumn("object", F.from_json(column, schema, {"mode": "PERMISSIVE"}))
    return parsed.filter(F.col(f"object.{sequence}").isNotNull())


def since(objects: DataFrame, after: int, sequence: str = "sequence_id") -> DataFrame:
    """Objects that came after a sequence, in the order of the feed."""
    return objects.filter(F.col(sequence) > after).orderBy(sequence)
