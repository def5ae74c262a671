"""Tables laid out by hash buckets: children beside their parents, entities by bucket, id sets as bitmaps by day."""

from __future__ import annotations

import datetime
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import read_table
from .entities import upsert_newer
from .sinks import to_contract, write_days


def save_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write df as an external table in so many buckets of its keys, sorted within, and read it back.

    A join or aggregate by the same keys then takes the table as it lies, without a shuffle, if there are at least as many
    buckets as the session's shuffle partitions. name goes into the session's catalog; drop it when the folder goes.
    """
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).option("compression", "zstd").mode("errorifexists").saveAsTable(name)
    return df.sparkSession.table(name)


class EntityBuckets:
    """An entity table in folders by the hash of its key; an upsert reads and rewrites only buckets that it touches.

    Rows of one bucket lie in one file, in key order. The number of buckets is fixed when the table is made: about as many
    as give files of a few hundred megabytes.
    """

    def __init__(self, path: str, schema: T.StructType, keys: Sequence[str], buckets: int, ts: str = "observed_at") -> None:
        self.path, self.keys, self.n, self.ts = path, list(keys), buckets, ts
        self.schema = schema
        self.stored_schema = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])

    def _placed(self, df: DataFrame) -> DataFrame:
        return to_contract(df, self.schema).withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(self.n)).cast("int"))

    def read(self, spark: SparkSession, buckets: Sequence[int] | None = None) -> DataFrame:
        stored = read_table(spark, self.path, self.stored_schema, "bucket")
        return (stored if buckets is None else stored.filter(F.col("bucket").isin(list(buckets)))).select(*self.schema.names)

    def upsert(self, incoming: DataFrame) -> list[int]:
        """Merge rows in, newer observations winning (``upsert_newer``); the buckets that were rewritten."""
        placed = self._placed(incoming)
        touched = sorted(r[0] for r in placed.select("bucket").distinct().collect())  # at most as many as there are buckets
        if touched:
            merged = upsert_newer(self.read(incoming.sparkSession, touched), to_contract(incoming, self.schema), self.keys, self.ts)
            rows = self._placed(merged).repartition(len(touched), "bucket").sortWithinPartitions("bucket", *self.keys)
            rows.write.partitionBy("bucket").mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(self.path)
        return touched


BITMAPS = T.StructType([T.StructField("kind", T.StringType()), T.StructField("part", T.LongType()), T.StructField("bits", T.BinaryType()), T.StructField("n_rows", T.LongType()), T.StructField("day", T.DateType())])


def id_bitmaps(facts: DataFrame, day: str, columns: Mapping[str, str]) -> DataFrame:
    """(kind, part, bits, n_rows, day): the positive ids of each day as bitmaps, 32,768 ids to a part; columns: kind by column."""
    pairs = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("long").alias("id")) for c, kind in columns.items()]))
    ids = facts.select(F.col(day).alias("day"), pairs.alias("x")).select("day", "x.*").filter("id > 0")
    parts = ids.withColumn("part", F.bitmap_bucket_number("id")).groupBy("day", "kind", "part")
    return parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"), F.count("*").alias("n_rows")).select(*BITMAPS.names)


def write_bitmaps(facts: DataFrame, path: str, day: str, columns: Mapping[str, str], days: Sequence[datetime.date] | None = None) -> None:
    """Keep the bitmaps of these days beside the facts; a changed day's are replaced, those of an emptied one go."""
    write_days(id_bitmaps(facts, day, columns), path, BITMAPS, "day", ["kind", "part"], list(days) if days else None)


def distinct_ids(bitmaps: DataFrame) -> DataFrame:
    """(kind, n_ids, n_rows): exact counts of different ids over all days of some bitmaps, without reading facts."""
    parts = bitmaps.groupBy("kind", "part").agg(F.bitmap_or_agg("bits").alias("bits"), F.sum("n_rows").alias("n_rows"))
    return parts.groupBy("kind").agg(F.sum(F.bitmap_count("bits")).alias("n_ids"), F.sum("n_rows").alias("n_rows"))


def distinct_ids_by_day(bitmaps: DataFrame) -> DataFrame:
    """(day, kind, n_ids, n_rows): as distinct_ids() for each day; a day's repeated rows are n_rows - n_ids."""
    return bitmaps.groupBy("day", "kind").agg(F.sum(F.bitmap_count("bits")).alias("n_ids"), F.sum("n_rows").alias("n_rows"))
