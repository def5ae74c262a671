"""The warehouse's input shapes, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..scratch import folder

LINE = "struct<part:bigint,supp:bigint,qty:double>"
DOCUMENT = "struct<id:bigint,time:string,party:struct<cust:bigint,status:string>,lines:array<struct<part:bigint,supp:bigint,qty:double,extra:string>>>"
ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
LINES_SQL = f"l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(ORDER)}) AS rn FROM lineitem)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.withColumn("rn", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*ORDER)))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(order_day, doc): each order as JSON; of every three lines the first holds the other two as an inner array."""
    part = F.struct(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"), F.col("l_quantity").alias("qty"))
    boxes = numbered_lines(spark, sf_dir).withColumn("box", F.expr("(rn + 2) div 3")).groupBy("l_orderkey", "box").agg(F.array_sort(F.collect_list(F.struct("rn", part.alias("p")))).alias("g"))
    inner = F.transform(F.slice("g", 2, 2), lambda x: x["p"])
    boxes = boxes.select("l_orderkey", "box", F.struct(F.col("g")[0]["p"]["part"].alias("part"), F.col("g")[0]["p"]["supp"].alias("supp"), F.col("g")[0]["p"]["qty"].alias("qty"), F.when(F.size("g") > 1, inner).alias("extra")).alias("line"))
    lines = boxes.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("box", "line"))), lambda x: x["line"]).alias("lines"))
    orders = table(spark, sf_dir, "orders")
    j = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left")
    time = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    doc = F.to_json(F.struct(F.col("o_orderkey").alias("id"), time.alias("time"), F.struct(F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status")).alias("party"), "lines"))
    landed = j.select(F.to_date("o_orderdate").alias("order_day"), doc.alias("doc"))
    path = folder(spark, "documents")
    landed.write.parquet(path)
    return spark.read.schema(landed.schema).parquet(path)


def three_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as rows of three sources that overlap; some stand in a later source date."""
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    of = F.filter(F.array(F.when(F.col("event_id") % 3 != 0, "a"), F.when(F.col("event_id") % 2 == 0, "b"), F.when(F.col("event_id") % 5 == 0, "live")), lambda x: x.isNotNull())
    late = F.when(F.col("event_id") % 97 == 0, 3).when(F.col("event_id") % 11 == 0, 1).otherwise(0)
    return e.withColumn("source", F.explode(of)).withColumn("source_date", F.date_add("day", late.cast("int"))).select("event_id", "day", "source", "source_date", "user_id", "event_type")


SOURCES_SQL = """e AS (SELECT *, CAST(ts AS DATE) AS day FROM events),
src AS (
  SELECT event_id, day, source, day + CASE WHEN event_id % 97 = 0 THEN 3 WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS source_date, user_id, event_type
  FROM e, (VALUES ('a'), ('b'), ('live')) s(source)
  WHERE (source = 'a' AND event_id % 3 <> 0) OR (source = 'b' AND event_id % 2 = 0) OR (source = 'live' AND event_id % 5 = 0)
)"""
ORDER_OF_SOURCES = ["a", "b", "live"]
RANK_SQL = "CASE source WHEN 'a' THEN 0 WHEN 'b' THEN 1 ELSE 2 END"
MERGED_SQL = f"""merged AS (
  SELECT *, list_sort(list_distinct(list(source) OVER (PARTITION BY day, event_id))) AS sources FROM src WHERE abs(source_date - day) <= 1
  QUALIFY row_number() OVER (PARTITION BY day, event_id ORDER BY {RANK_SQL}, source_date) = 1
)"""

AFFILIATES_SQL = """snap AS (SELECT c_custkey AS id, c_nationkey AS group_id, c_nationkey % 5 AS parent_id, c_mktsegment AS title, c_custkey % 23 = 0 AS deleted FROM customer)"""


def base_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("title"), F.lit("2024-01-02").cast("timestamp_ntz").alias("observed_at"), F.lit("base").alias("source"))


def incoming_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    day = F.element_at(F.array(*map(F.lit, ("2024-01-03", "2024-01-01", "2024-01-02"))), (F.col("c_custkey") % 4 + 1).cast("int"))
    old = c.filter("c_custkey % 4 < 3").select(F.col("c_custkey").alias("id"), day.cast("timestamp_ntz").alias("observed_at"), "c_name", "c_mktsegment")
    new = c.filter("c_custkey % 50 = 0").select((F.col("c_custkey") + 1000000).alias("id"), F.lit("2024-01-03").cast("timestamp_ntz").alias("observed_at"), "c_name", "c_mktsegment")
    return old.unionByName(new).select("id", F.concat("c_name", F.lit("*")).alias("name"), F.lower("c_mktsegment").alias("title"), "observed_at", F.lit("incoming").alias("source"))


BASE_SQL = """base AS (SELECT c_custkey AS id, c_name AS name, c_mktsegment AS title, TIMESTAMP '2024-01-02' AS observed_at, 'base' AS source FROM customer),
incoming AS (
  SELECT c_custkey AS id, c_name || '*' AS name, lower(c_mktsegment) AS title, CASE c_custkey % 4 WHEN 0 THEN TIMESTAMP '2024-01-03' WHEN 1 THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-01-02' END AS observed_at, 'incoming' AS source FROM customer WHERE c_custkey % 4 < 3
  UNION ALL SELECT c_custkey + 1000000, c_name || '*', lower(c_mktsegment), TIMESTAMP '2024-01-03', 'incoming' FROM customer WHERE c_custkey % 50 = 0
)"""


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("record_id"), F.to_date("o_orderdate").alias("start_date"), F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderstatus")).alias("value"))


HISTORY_SQL = "h AS (SELECT o_custkey AS id, o_orderkey AS record_id, CAST(o_orderdate AS DATE) AS start_date, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderstatus END AS value FROM orders)"


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderstatus").alias("kind"),
        F.col("o_orderkey").alias("entity_id"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
        F.when(F.col("o_orderkey") % 3 != 0, F.date_sub(F.to_date("o_orderdate"), 400).cast("timestamp_ntz")).alias("last_refreshed_at"),
        F.col("o_orderdate").alias("next_due_at"),
        F.lit(None).cast("string").alias("etag"),
        (F.col("o_orderkey") % 6).cast("int").alias("failures"),
        F.when(F.col("o_orderkey") % 6 > 0, F.lit("timeout")).alias("last_error"),
    )


QUEUE_SQL = """q AS (
  SELECT o_orderstatus AS kind, o_orderkey AS entity_id, CAST(substr(o_orderpriority, 1, 1) AS INT) AS priority,
    CASE WHEN o_orderkey % 3 <> 0 THEN o_orderdate - INTERVAL 400 DAY END AS last_refreshed_at, CAST(o_orderdate AS TIMESTAMP) AS next_due_at,
    CAST(o_orderkey % 6 AS INT) AS failures, CASE WHEN o_orderkey % 6 > 0 THEN 'timeout' END AS last_error FROM orders
)"""


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("logical_date")).agg(F.count("*").alias("n")).withColumn("d", F.dayofmonth("logical_date"))


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upstream objects, one a day of events, with defects on fixed days."""
    d = F.col("d")
    return event_days(spark, sf_dir).select(
        F.when(d % 2 == 0, "events").otherwise("market").alias("dataset"),
        F.concat(F.date_format("logical_date", "yyyy"), F.lit("/"), F.col("logical_date").cast("string")).alias("object_key"),
        "logical_date",
        F.when(d == 3, "failed").when(d == 4, "provisional").when(d == 5, "gone").when(d == 6, "discovered").when(d == 29, "changed").otherwise("imported").alias("status"),
        F.when(d % 2 == 0, 2).otherwise(1).alias("current_revision"),
        F.md5(F.col("n").cast("string")).alias("etag"),
        F.col("n").alias("size"),
        F.date_add("logical_date", 1).cast("timestamp_ntz").alias("last_modified"),
        F.when(d % 10 != 0, F.col("n") + F.when(d.isin(7, 8), 5).otherwise(0)).alias("expected_count"),
        (F.col("n") - F.when(d == 9, 1).otherwise(0)).alias("observed_count"),
        F.date_add("logical_date", 2).cast("timestamp_ntz").alias("last_seen_at"),
        "d",
    )


def revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir).withColumn("revision", F.explode(F.sequence(F.lit(1), "current_revision"))).filter("NOT (d = 11 AND revision = current_revision)")
    path = F.concat(F.lit("raw/"), "object_key", F.lit("."), F.col("revision").cast("string"))
    return o.select(
        "dataset", "object_key", "revision", F.sha2(path, 256).alias("sha256"), F.when(F.col("d") % 7 != 0, path).alias("raw_path"),
        F.when((F.col("d") == 8) & (F.col("revision") == F.col("current_revision")), "other").otherwise(F.col("etag")).alias("upstream_etag"),
        F.when(F.col("d") < 12, 1).otherwise(2).alias("parser_version"),
        F.when(~F.col("d").isin(3, 6), F.expr("date_add(logical_date, 1 + revision)")).cast("timestamp_ntz").alias("imported_at"), "d",
        F.when(F.col("revision") == F.col("current_revision"), F.col("observed_count")).otherwise(F.col("observed_count") - 1).alias("observed_count"),
    )


def partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir).filter("d NOT IN (3, 5, 6)").withColumn("table_name", F.explode(F.array(F.lit("facts"), F.lit("parts")))).filter("NOT (d = 13 AND table_name = 'parts')")
    made = o.select("table_name", "logical_date", F.col("size").alias("n_rows"), "dataset", "object_key", F.when(F.col("d") == 15, 0).otherwise(F.col("current_revision")).alias("revision"), F.when(F.col("d") == 17, F.array(F.lit("x"), F.lit("y"))).otherwise(F.expr("cast(array() AS array<string>)")).alias("unknown_keys"))
    lone = objects(spark, sf_dir).filter("d = 15").select(F.lit("facts").alias("table_name"), F.date_add("logical_date", 100).alias("logical_date"), F.col("size").alias("n_rows"), "dataset", F.concat("object_key", F.lit("-old")).alias("object_key"), F.lit(1).alias("revision"), F.expr("cast(array() AS array<string>)").alias("unknown_keys"))
    return made.unionByName(lone)


OBJECTS_SQL = """days AS (SELECT CAST(ts AS DATE) AS logical_date, count(*) AS n, day(CAST(ts AS DATE)) AS d FROM events GROUP BY 1, 3),
obj AS (
  SELECT CASE WHEN d % 2 = 0 THEN 'events' ELSE 'market' END AS dataset, strftime(logical_date, '%Y') || '/' || logical_date AS object_key, logical_date,
    CASE d WHEN 3 THEN 'failed' WHEN 4 THEN 'provisional' WHEN 5 THEN 'gone' WHEN 6 THEN 'discovered' WHEN 29 THEN 'changed' ELSE 'imported' END AS status,
    CASE WHEN d % 2 = 0 THEN 2 ELSE 1 END AS current_revision, md5(CAST(n AS VARCHAR)) AS etag, n AS size, CAST(logical_date + 1 AS TIMESTAMP) AS last_modified,
    CASE WHEN d % 10 <> 0 THEN n + CASE WHEN d IN (7, 8) THEN 5 ELSE 0 END END AS expected_count, n - CASE WHEN d = 9 THEN 1 ELSE 0 END AS observed_count,
    CAST(logical_date + 2 AS TIMESTAMP) AS last_seen_at, d FROM days
),
rev AS (
  SELECT dataset, object_key, revision, sha256('raw/' || object_key || '.' || revision) AS sha256, CASE WHEN d % 7 <> 0 THEN 'raw/' || object_key || '.' || revision END AS raw_path,
    CASE WHEN d = 8 AND revision = current_revision THEN 'other' ELSE etag END AS upstream_etag, CASE WHEN d < 12 THEN 1 ELSE 2 END AS parser_version,
    CASE WHEN d NOT IN (3, 6) THEN CAST(logical_date + 1 + revision AS TIMESTAMP) END AS imported_at, d, CASE WHEN revision = current_revision THEN observed_count ELSE observed_count - 1 END AS observed_count
  FROM (SELECT *, CAST(unnest(generate_series(1, current_revision)) AS INT) AS revision FROM obj) WHERE NOT (d = 11 AND revision = current_revision)
),
part_ AS (
  SELECT table_name, logical_date, size AS n_rows, dataset, object_key, CASE WHEN d = 15 THEN 0 ELSE current_revision END AS revision, CASE WHEN d = 17 THEN 'x,y' ELSE '' END AS unknown_keys
  FROM obj, (VALUES ('facts'), ('parts')) t(table_name) WHERE d NOT IN (3, 5, 6) AND NOT (d = 13 AND table_name = 'parts')
  UNION ALL SELECT 'facts', logical_date + 100, size, dataset, object_key || '-old', 1, '' FROM obj WHERE d = 15
),
live AS (SELECT * FROM obj WHERE status IN ('imported', 'provisional'))"""
