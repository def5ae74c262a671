"""Tables by buckets and bitmaps, bounded results and scalar functions over the given tables."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars
from ..operators import buckets, merge, nested, sinks
from ..scratch import folder
from ..sources import files
from ._register import registry
from .inputs import BASE_SQL, MERGED_SQL, ORDER_OF_SOURCES, SOURCES_SQL, base_snapshot, incoming_snapshot, table, three_sources

query, QUERIES, ORACLES = registry()


@query(f"""WITH {SOURCES_SQL}, {MERGED_SQL} SELECT m.event_id, m.source, m.source_date, m.day, o.ordinal, m.user_id * 10 + length(m.source) + o.ordinal AS amount FROM merged m, (VALUES (1), (2)) o(ordinal)""")
def merge_children_bucketed(spark, sf_dir):
    """Children that lie in buckets of id, source and source date, joined with their chosen parents where they lie."""
    s = three_sources(spark, sf_dir)
    children = s.select("event_id", "source", "source_date", "user_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("ordinal")).withColumn("amount", F.col("user_id") * 10 + F.length("source") + F.col("ordinal")).drop("user_id")
    n = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    children = buckets.save_bucketed(children, f"daymill_children_{uuid.uuid4().hex}", folder(spark, "children"), ["event_id", "source", "source_date"], n)
    chosen = merge.merge_by_precedence(s, "event_id", "day", "source_date", ORDER_OF_SOURCES)
    return merge.children_of_chosen(children, chosen.hint("merge"), "event_id")


ENTITY = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("title", T.StringType()), T.StructField("observed_at", T.TimestampNTZType()), T.StructField("source", T.StringType())])


@query(f"""WITH {BASE_SQL}, u AS (SELECT *, 0 AS side FROM base UNION ALL SELECT *, 1 FROM incoming)
SELECT id, name, title, strftime(observed_at, '%Y-%m-%d %H:%M:%S') AS observed_at, source FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY observed_at DESC, side DESC) = 1""")
def upsert_buckets(spark, sf_dir):
    entities = buckets.EntityBuckets(folder(spark, "entities"), ENTITY, ["id"], 16)
    entities.upsert(base_snapshot(spark, sf_dir))
    for k in (1, 0):  # two batches
        entities.upsert(incoming_snapshot(spark, sf_dir).filter(F.col("id") % 2 == k))
    return entities.read(spark).select("id", "name", "title", F.date_format("observed_at", "yyyy-MM-dd HH:mm:ss").alias("observed_at"), "source")


_IDS = "o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS day, o_custkey, o_orderkey % 1000 AS k FROM orders)"
_KINDS = {"o_custkey": "customer", "k": "rest"}


def _bitmaps(spark, sf_dir):
    """Bitmaps of each month's ids, of which one month's were written with too few orders at first."""
    o = table(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "month").alias("day"), "o_custkey", (F.col("o_orderkey") % 1000).alias("k"))
    path = folder(spark, "bitmaps")
    last = o.agg(F.max("day")).first()[0]
    if last is None:
        return spark.createDataFrame([], buckets.BITMAPS)
    buckets.write_bitmaps(o.filter((F.col("day") < last) | (F.col("k") % 2 == 0)), path, "day", _KINDS)
    buckets.write_bitmaps(o.filter(F.col("day") == last), path, "day", _KINDS, [last])
    return files.read_table(spark, path, buckets.BITMAPS, "day")


@query(f"""WITH {_IDS} SELECT 'customer' AS kind, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_ids, CAST(count(*) AS BIGINT) AS n_rows FROM o WHERE day >= DATE '1996-01-01' AND o_custkey > 0 HAVING count(*) > 0
UNION ALL SELECT 'rest', CAST(count(DISTINCT k) AS BIGINT), CAST(count(*) AS BIGINT) FROM o WHERE day >= DATE '1996-01-01' AND k > 0 HAVING count(*) > 0""")
def distinct_by_bitmaps(spark, sf_dir):
    return buckets.distinct_ids(_bitmaps(spark, sf_dir).filter("day >= DATE '1996-01-01'"))


@query(f"""WITH {_IDS} SELECT day, 'customer' AS kind, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n_ids, CAST(count(*) AS BIGINT) AS n_rows FROM o WHERE o_custkey > 0 GROUP BY day
UNION ALL SELECT day, 'rest', CAST(count(DISTINCT k) AS BIGINT), CAST(count(*) AS BIGINT) FROM o WHERE k > 0 GROUP BY day""")
def day_counts_by_bitmaps(spark, sf_dir):
    return buckets.distinct_ids_by_day(_bitmaps(spark, sf_dir))


@query("SELECT n_nationkey, n_name FROM nation")
def bounded_result(spark, sf_dir):
    """A bounded result as Arrow batches and as rows, which hold the same."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    batches, rows = sinks.to_arrow(n, 7), sinks.to_rows(n, 1000)
    same = sorted(pa.Table.from_batches(batches).to_pylist(), key=str) == sorted(rows["rows"], key=str) if batches else not rows["rows"]
    if not same or any(b.num_rows > 7 for b in batches):
        raise ValueError("the two forms of a result differ")
    return spark.createDataFrame(pa.Table.from_batches(batches) if batches else n.toArrow())


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE CAST(o_orderdate AS DATE) IN (SELECT min(CAST(o_orderdate AS DATE)) FROM orders)")
def single_day(spark, sf_dir):
    """One day's rows, checked in the same pass to be of that day alone."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    first = o.agg(F.min("day")).first()[0]
    return nested.assert_single_day(o.filter(F.col("day") == F.lit(first)), "day", first)


@query("""SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS iso, CASE WHEN o_orderkey % 5 <> 0 THEN strftime(to_timestamp(o_orderkey + 900000000) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') END AS epoch,
  strftime(o_orderdate + INTERVAL 3661 SECOND, '%Y-%m-%d %H:%M:%S') AS http, CASE WHEN o_orderkey % 7 <> 0 THEN md5(CAST(o_orderkey AS VARCHAR)) END AS tag FROM orders""")
def lenient_times(spark, sf_dir):
    """ISO, epoch and HTTP times and entity tags, some of them unreadable."""
    o = table(spark, sf_dir, "orders")
    key, at = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    iso = F.when(key % 3 == 0, "soon").when(key % 3 == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(F.date_format(at, "yyyy-MM-dd HH:mm:ss'+00'"))
    epoch = F.when(key % 5 == 0, "later").otherwise((key + 900_000_000).cast("string"))
    weekday = F.element_at(F.array(*map(F.lit, ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"))), F.dayofweek(at))
    http = F.concat(weekday, F.lit(", "), F.date_format(at + F.expr("INTERVAL 3661 SECONDS"), "dd MMM yyyy HH:mm:ss 'GMT'"))
    tag = F.when(key % 7 == 0, '""').when(key % 2 == 0, F.concat(F.lit('W/"'), F.md5(key.cast("string")), F.lit('"'))).otherwise(F.md5(key.cast("string")))
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    made = o.select(key.alias("id"), iso.alias("iso"), epoch.alias("epoch"), http.alias("http"), tag.alias("tag"))
    return made.select("id", text(scalars.lenient_timestamp(F.col("iso"))).alias("iso"), text(scalars.epoch_timestamp(F.col("epoch"))).alias("epoch"), text(scalars.http_timestamp(F.col("http"))).alias("http"), scalars.bare_tag(F.col("tag")).alias("tag"))


@query("""SELECT o_orderkey AS id, 'day=' || CAST(o_orderdate AS DATE) AS folder, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
  strftime(o_orderdate, '%Y') || '/orders-' || CAST(o_orderdate AS DATE) AS object_key FROM orders""")
def partition_names(spark, sf_dir):
    """Names of partitions and objects, built and read."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.to_date("o_orderdate").alias("d"))
    name = scalars.partition_name("day", F.col("d"))
    path = F.concat(F.lit("lake/orders/"), F.when(F.col("id") % 4 == 0, F.lit("day=never")).otherwise(name), F.lit("/part-0"))
    raw = F.concat(F.lit("raw/"), F.date_format("d", "yyyy"), F.lit("/orders-"), F.col("d").cast("string"), F.element_at(F.array(*map(F.lit, (".csv.bz2", ".tar.gz", ".json"))), (F.col("id") % 3 + 1).cast("int")))
    return o.select("id", name.alias("folder"), scalars.partition_day("day", path).alias("day"), scalars.object_key(raw).alias("object_key"))
