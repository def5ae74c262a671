"""Helpers that the corpus operators share: scratch tables, Arrow batch limits, sizes of shuffles."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null doc_id inside operators: it is larger than any other, so it never takes text from others.
NO_ID = (1 << 63) - 1


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, or a temporary one in local mode."""
    conf = spark.sparkContext.getConf()
    base = conf.get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared scratch folder and read it back; this cuts lineage and survives lost executors."""
    path = f"{scratch_dir(df.sparkSession)}/daymill-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000, mega: int = 8) -> None:
    """Bound what a Python worker holds at once, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(mega << 20))


def shuffle_width(spark: SparkSession) -> int:
    """How many partitions the session's shuffles have."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


_M1, _M2, _M3, _M4, _M5 = (np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def xxhash64_of_longs(x: np.ndarray, seed: int = 42) -> np.ndarray:
    """What Spark's xxhash64() gives for a bigint column, as uint64."""
    h = np.uint64(seed) + _M5 + np.uint64(8)
    h = h ^ (_rotl(x.astype(np.int64).view(np.uint64) * _M2, 31) * _M1)
    h = _rotl(h, 27) * _M1 + _M4
    h = (h ^ (h >> np.uint64(33))) * _M2
    h = (h ^ (h >> np.uint64(29))) * _M3
    return h ^ (h >> np.uint64(32))
