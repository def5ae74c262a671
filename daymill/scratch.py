"""Scratch folders for what has to go through files: under spark.checkpoint.dir, or temporary in local mode."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
