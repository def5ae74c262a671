"""The live feed: newest sequence per id wins, touched days are rewritten and merged; nothing is dropped for being late."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sinks import files_for, write_days
from ..sources.files import read_feed, read_table


def newest_per_key(df: DataFrame, keys: list[str], sequence: str, fetched: str | None = None) -> DataFrame:
    """One row per key, of the highest sequence; among equal ones the one fetched last, and then by a digest of the row."""
    order = [F.col(sequence).desc(), *([F.col(fetched).desc()] if fetched else []), F.xxhash64(*df.columns)]
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__n = 1").drop("__n")


def split_skipped(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """df with usable: whether an object has its ids and a day; others are counted and passed over."""
    usable = F.col(day).isNotNull()
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    return df.withColumn("usable", usable)


def replace_keys(existing: DataFrame, incoming: DataFrame, keys: list[str], sequence: str, order: list[str]) -> DataFrame:
    """existing and incoming with one row per key, of the higher sequence, so that replayed batches change nothing."""
    both = existing.withColumn("__side", F.lit(0)).unionByName(incoming.withColumn("__side", F.lit(1)))
    newest = Window.partitionBy(*keys).orderBy(F.col(sequence).desc_nulls_last(), F.col("__side").desc())
    kept = both.withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n", "__side")
    return kept.orderBy(*[F.col(c).asc_nulls_first() for c in order])


def replace_children(existing: DataFrame, incoming: DataFrame, replaced: DataFrame, keys: list[str]) -> DataFrame:
    """Children without those of replaced parents, and the incoming ones."""
    return existing.join(replaced.select(*keys).distinct(), keys, "left_anti").unionByName(incoming)


def sequence_gaps(df: DataFrame, sequence: str, at: str, now, age_s: int = 120) -> DataFrame:
    """(after, before, missing): stretches of absent sequences, once the next object is older than age_s.

    The sequence is cut into ranges first, so that no window runs over the whole feed: a gap is found where two
    neighbours in a range are apart, or where one range's last and the next one's first are.
    """
    width = 1 << 16
    ranged = df.select(F.col(sequence).alias("s"), F.col(at).alias("t")).distinct().withColumn("r", F.expr(f"s div {width}"))
    inside = ranged.withColumn("next", F.lead("s").over(Window.partitionBy("r").orderBy("s"))).withColumn("next_t", F.lead("t").over(Window.partitionBy("r").orderBy("s")))
    gaps = inside.filter("next - s > 1").select(F.col("s").alias("after"), F.col("next").alias("before"), F.col("next_t").alias("t"))
    ends = ranged.groupBy("r").agg(F.min("s").alias("first"), F.min_by("t", "s").alias("first_t"), F.max("s").alias("last"))
    across = Window.orderBy("r")
    between = ends.select(F.col("last").alias("after"), F.lead("first").over(across).alias("before"), F.lead("first_t").over(across).alias("t")).filter("before - after > 1")
    old = F.col("t") <= F.lit(now).cast(df.schema[at].dataType) - F.expr(f"INTERVAL {age_s} SECONDS")
    return gaps.unionByName(between).filter(old).select("after", "before", (F.col("before") - F.col("after") - 1).alias("missing"))


def feed_status(df: DataFrame, sequence: str, uploaded: str, fetched: str) -> DataFrame:
    """(day, n_objects, newest_sequence, last_upload, lag_s) by day of fetching."""
    lag = F.max(F.unix_micros(F.col(fetched).cast("timestamp")) - F.unix_micros(F.col(uploaded).cast("timestamp"))) / 1e6
    return df.groupBy(F.to_date(fetched).alias("day")).agg(F.count("*").alias("n_objects"), F.max(sequence).alias("newest_sequence"), F.max(uploaded).alias("last_upload"), F.round(lag, 3).alias("lag_s"))


@dataclasses.dataclass(frozen=True)
class Child:
    """A daily table of rows below the objects: rows() gives them, with the object's key and day, of a batch's objects."""

    path: str
    schema: T.StructType
    order: list[str]
    rows: Callable[[DataFrame], DataFrame]


class LiveFlush:
    """A feed stream's batches into a daily table: newest per id, replaced inside its days, then what follows them.

    process() is a foreachBatch function. A batch may come again after a failure: rows already stored with the same or
    a higher sequence stay, so the table ends up the same. Only the days of the batch are read and rewritten. Children of
    replaced objects go and the new object's come; they are written before the objects, so that a batch that failed in
    between is done anew as a whole. ``after`` gets the touched days, for instance to merge them (``layers.rebuild``).

    drift: a table of what batches hold beyond the contract, and what gives it as (scope, key, documents) of a batch; a
    batch that comes again replaces its own report. Skipped objects are counted by batch for the same reason.
    """

    def __init__(self, path: str, schema: T.StructType, key: str, sequence: str, day: str, fetched: str | None = None, after: Callable[[SparkSession, DataFrame], None] | None = None, children: Sequence[Child] = (), drift: tuple[str, Callable[[DataFrame], DataFrame]] | None = None) -> None:
        self.children, self.drift = children, drift
        self.path, self.schema, self.key, self.sequence, self.day, self.fetched, self.after = path, schema, key, sequence, day, fetched, after
        self.skipped_by_batch: dict[int, int] = {}

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marked = split_skipped(batch, [self.key], self.day).persist()
        newest = newest_per_key(marked.filter("usable"), [self.key], self.sequence, self.fetched).persist()  # each table needs it
        try:
            counts = marked.agg(F.count_if(~F.col("usable")), F.count_if("usable")).first()
            self.skipped_by_batch[batch_id] = counts[0]
            if self.drift:
                self.drift[1](marked).write.mode("overwrite").parquet(f"{self.drift[0]}/batch={batch_id}")
            if not counts[1]:
                return
            incoming = newest.select(*self.schema.names)
            days = [r[0] for r in incoming.select(self.day).distinct().collect()]  # days of one batch
            stored = self.stored(spark).filter(F.col(self.day).isin(days))
            files = files_for(counts[1] + stored.count(), len(days))
            before = stored.select(self.key, F.col(self.sequence).alias("__before"))
            replaced = newest.join(before, self.key, "left").filter(F.col("__before").isNull() | (F.col(self.sequence) >= F.col("__before"))).drop("__before")
            for c in self.children:
                own = read_table(spark, c.path, c.schema, self.day).filter(F.col(self.day).isin(days))
                rows = replace_children(own, c.rows(replaced).select(*c.schema.names), replaced, [self.key])
                write_days(rows, c.path, c.schema, self.day, c.order, days, files)
            write_days(replace_keys(stored, incoming, [self.key], self.sequence, [self.key]), self.path, self.schema, self.day, [self.key], files=files)
            if self.after:
                self.after(spark, spark.createDataFrame([(d,) for d in days], f"{self.day} date"))
        finally:
            newest.unpersist()
            marked.unpersist()

    @property
    def skipped(self) -> int:
        return sum(self.skipped_by_batch.values())

    def stored(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path, self.schema, self.day)

    def start(self, lines: DataFrame, parse: Callable[[DataFrame], DataFrame], checkpoint: str, every: str | None = "30 seconds"):
        """Start on a stream of lines; every None runs over what is there and stops."""
        writer = parse(lines).writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return (writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)).start()


def feed_lines(spark: SparkSession, folder: str, per_batch: int = 100) -> DataFrame:
    """A stream over landed, immutable files of feed objects, one a line."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", per_batch).load(folder)


def parsed_feed(lines: DataFrame, schema: str, sequence: str) -> DataFrame:
    return read_feed(lines, schema, "value", sequence).select("object.*")
