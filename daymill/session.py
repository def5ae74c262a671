"""The session settings that the warehouse relies on."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def session(builder: SparkSession.Builder | None = None) -> SparkSession:
    return (builder or SparkSession.builder).config(map=SETTINGS).getOrCreate()
