"""Projections of feed objects, snapshots, API bodies and market days to contract rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import lenient_timestamp


def feed_metadata(df: DataFrame, object_: str = "object", meta: str = "meta") -> DataFrame:
    """Metadata rows of feed objects: epoch seconds to a time, the hash of the object or else of its metadata, labels as strings."""
    o, m = F.col(object_), F.col(f"{object_}.{meta}")
    return df.select(
        o["id"].alias("id"),
        o["sequence_id"].alias("sequence_id"),
        F.timestamp_seconds(o["uploaded_at"].try_cast("bigint")).alias("uploaded_at"),
        F.coalesce(o["hash"], m["hash"]).alias("hash"),
        m["total"].alias("total_value"),
        F.transform(m["labels"], lambda x: x.cast("string")).alias("labels"),
    )


def event_day(time: Column) -> Column:
    """The UTC day of an ISO time, or null if it can't be read."""
    return F.to_date(lenient_timestamp(time))


def first_id(*ids: Column) -> Column:
    return F.coalesce(*ids)


def entity_rows(df: DataFrame, key: str, observed_at, source: str, times: list[str] = ()) -> DataFrame:
    """Snapshot rows: lenient times, deleted false by default, observed when the record was updated or else at the snapshot."""
    out = df
    for c in times:
        out = out.withColumn(c, lenient_timestamp(F.col(c)))
    out = out.withColumn("deleted", F.coalesce("deleted", F.lit(False)))
    out = out.withColumn("observed_at", F.coalesce(lenient_timestamp(F.col("updated")), F.lit(observed_at).cast("timestamp"))).drop("updated")
    return out.filter(F.col(key).isNotNull()).withColumn("source", F.lit(source))


def history_rows(df: DataFrame, key: str, history: str = "history", record: str = "record_id") -> DataFrame:
    """One row an event of an entity's history; events without a record id are dropped."""
    return df.select(key, F.explode(history).alias("h")).select(key, "h.*").filter(F.col(record).isNotNull())


def real_records(df: DataFrame, name: str = "name", error: str = "error") -> DataFrame:
    """Records without an error and with a name."""
    return df.filter(F.col(error).isNull() & F.col(name).isNotNull())


def typed(body: Column, schema: str) -> Column:
    """The fields of a body by a strict schema: a value of another JSON type is null, and the rest stays."""
    return F.from_json(body, schema, {"mode": "PERMISSIVE"})


def observation_rows(df: DataFrame, body: str, key: str, closed_group: int, observed_at: str) -> DataFrame:
    """Rows from API bodies {name, group, state}: deleted if in the group of closed ones or in the closed state."""
    b = typed(F.col(body), "struct<name:string,group:bigint,state:string>")
    rows = df.select(key, observed_at, b.alias("b"))
    deleted = (F.col("b.group").eqNullSafe(F.lit(closed_group))) | (F.col("b.state").eqNullSafe(F.lit("closed")))
    return rows.select(key, observed_at, F.col("b.name").alias("name"), F.col("b.group").alias("group_id"), deleted.alias("deleted"))


def body_ids(c: Column) -> Column:
    """The distinct positive ids of an array, sorted; a body that is no array is an error."""
    return F.array_sort(F.array_distinct(F.filter(c, lambda x: x > 0)))


def json_body_ids(body: Column) -> Column:
    """body_ids() of a JSON text."""
    return F.when(F.ltrim(body).startswith("["), body_ids(F.from_json(body, "array<bigint>"))).otherwise(F.raise_error(F.lit("the body is no array")).cast("array<bigint>"))


def market_rows(df: DataFrame) -> DataFrame:
    """Market days in contract order, with lenient modification times; rows of a task by region and type, as a day is
    written by one (write_days orders each day anyway)."""
    time = F.try_to_timestamp(F.col("http_last_modified"), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'"))
    columns = ["date", "region_id", "type_id", "average", "highest", "lowest", "volume", "order_count"]
    return df.select(*columns, time.alias("http_last_modified")).sortWithinPartitions("region_id", "type_id")
