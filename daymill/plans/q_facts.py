"""Sources, nested documents, feed rows, merges, sinks and the live feed over the given tables."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars
from ..operators import layers, merge, nested, rows, sinks
from ..scratch import folder
from ..sources import archives, files, json_arrays, listings, sequence_feed, stores
from ..streaming import feed, gaps
from ._register import registry
from .inputs import DOCUMENT, LINE, LINES_SQL, MERGED_SQL, ORDER_OF_SOURCES, SOURCES_SQL, documents, table, three_sources

query, QUERIES, ORACLES = registry()


# Sources


@query("SELECT role AS path, conv_id, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(turn) AS BIGINT) AS turns FROM conversations GROUP BY ALL")
def src_tar_json(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").withColumn("g", F.concat_ws("/", "role", F.expr("conv_id div 50").cast("string")))
    name = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    packed = archives.pack_tar(c.select("g", F.concat(name, F.lit(".json")).alias("n"), F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("t")), "g", "n", "t")
    docs = files.parse_documents(archives.unpack_json(packed.select(F.col("g").alias("path"), "content")), "struct<conv_id:bigint,turn:bigint,role:string>")
    return docs.groupBy(F.col("doc.role").alias("path"), "doc.conv_id").agg(F.count("*").alias("n_docs"), F.sum("doc.turn").alias("turns"))


@query("SELECT role AS path, 'turns.txt' AS member, CAST(count(*) AS BIGINT) AS n_lines FROM conversations GROUP BY ALL")
def src_tar_members(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").groupBy("role", F.expr("conv_id div 50").alias("k")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("conv_id", "turn"))), lambda x: F.concat_ws(",", x["conv_id"].cast("string"), x["turn"].cast("string"))), "\n").alias("t"))
    c = c.select(F.concat_ws("/", "role", F.col("k").cast("string")).alias("g"), F.concat(F.lit("data/"), F.lit("turns.txt")).alias("n"), "t")
    packed = archives.pack_tar(c, "g", "n", "t").select(F.col("g").alias("path"), "content")
    lines = archives.unpack_members(packed, ["turns.txt"])
    return lines.groupBy(F.split("path", "/")[0].alias("path"), "member").agg(F.count("*").alias("n_lines"))


def _archives(spark, packed):
    """Packed archives (g, content) as files."""
    path = folder(spark, "archives")
    stores.write_files(packed.select(F.concat(F.translate("g", "/", "-"), F.lit(".tar")).alias("name"), "content"), path)
    return path


@query("SELECT role AS path, conv_id, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(turn) AS BIGINT) AS turns FROM conversations GROUP BY ALL")
def src_tar_split(spark, sf_dir):
    """Members of plain archives, dealt by their places in the archives to several tasks each."""
    c = table(spark, sf_dir, "conversations").withColumn("g", F.concat_ws("/", "role", F.expr("conv_id div 200").cast("string")))
    name = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    packed = archives.pack_tar(c.select("g", F.concat(name, F.lit(".json")).alias("n"), F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("t")), "g", "n", "t")
    docs = files.parse_documents(archives.read_tar_documents(spark, _archives(spark, packed), chunk=1 << 17), "struct<conv_id:bigint,turn:bigint,role:string>")
    return docs.groupBy(F.col("doc.role").alias("path"), "doc.conv_id").agg(F.count("*").alias("n_docs"), F.sum("doc.turn").alias("turns"))


@query("SELECT role AS path, 'turns.txt' AS member, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(conv_id * 100 + turn) AS BIGINT) AS total FROM conversations GROUP BY ALL")
def src_tar_lines(spark, sf_dir):
    """The lines of named members, each member read by several tasks."""
    c = table(spark, sf_dir, "conversations").groupBy("role", F.expr("conv_id div 2000").alias("k")).agg(F.array_join(F.collect_list((F.col("conv_id") * 100 + F.col("turn")).cast("string")), "\n").alias("t"))
    packed = archives.pack_tar(c.select(F.concat_ws("/", "role", F.col("k").cast("string")).alias("g"), F.lit("data/turns.txt").alias("n"), "t"), "g", "n", "t")
    lines = archives.read_tar_lines(spark, _archives(spark, packed), ["turns.txt"], chunk=1 << 12)
    role = F.regexp_extract("path", r"/([a-z]+)-\d+\.tar$", 1)
    return lines.groupBy(role.alias("path"), "member").agg(F.count("*").alias("n_lines"), F.sum(F.col("line").cast("long")).alias("total"))


CSV_TYPES = {"date": "date", "region_id": "bigint", "type_id": "bigint", "average": "double", "highest": "double", "lowest": "double", "volume": "bigint", "order_count": "bigint", "http_last_modified": "string"}


@query("""SELECT CAST(o_orderdate AS DATE) AS date, o_custkey AS region_id, o_orderkey AS type_id, o_totalprice AS average, o_totalprice + 1 AS highest, o_totalprice - 1 AS lowest,
  o_orderkey % 100 AS volume, o_orderkey % 7 AS order_count, CASE WHEN o_orderkey % 2 = 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS modified FROM orders""")
def src_csv_by_name(spark, sf_dir):
    return read_csv(spark, land_csv(spark, sf_dir))


def land_csv(spark, sf_dir):
    """Orders as bz2 files in two column orders; gives their folder."""
    o = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date"), F.col("o_custkey").alias("region_id"), F.col("o_orderkey").alias("type_id"), F.col("o_totalprice").alias("average"), (F.col("o_totalprice") + 1).alias("highest"), (F.col("o_totalprice") - 1).alias("lowest"), (F.col("o_orderkey") % 100).alias("volume"), (F.col("o_orderkey") % 7).alias("order_count"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("http_last_modified"))
    path = folder(spark, "csv")
    older = ["date", "region_id", "type_id", "average", "lowest", "highest", "volume", "order_count"]
    newer = ["average", "date", "highest", "lowest", "order_count", "volume", "http_last_modified", "region_id", "type_id"]
    o.filter("type_id % 2 = 0").select(older).write.csv(f"{path}/older", header=True, compression="bzip2")
    o.filter("type_id % 2 = 1").select(newer).write.csv(f"{path}/newer", header=True, compression="bzip2")
    return path


def read_csv(spark, path):
    read = files.read_daily_csv(spark, [f"{path}/older", f"{path}/newer"], CSV_TYPES, ["http_last_modified"])
    return rows.market_rows(read).withColumn("modified", F.date_format("http_last_modified", "yyyy-MM-dd HH:mm:ss")).drop("http_last_modified")


@query("SELECT o_orderkey AS id, o_custkey AS cust, CASE WHEN o_orderkey % 2 = 0 THEN md5(CAST(o_orderkey AS VARCHAR)) END AS hash FROM orders")
def src_json_map(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("day", F.trunc("o_orderdate", "year"))
    key = F.col("o_orderkey").cast("string")
    path = folder(spark, "map")
    for name, value, part in (("docs", F.to_json(F.struct(F.col("o_custkey").alias("cust"))), o), ("index", F.md5(key), o.filter("o_orderkey % 2 = 0"))):
        pair = F.concat(F.lit('"'), key, F.lit('":'), value if name == "docs" else F.concat(F.lit('"'), value, F.lit('"')))
        body = part.groupBy("day").agg(F.concat(F.lit("{"), F.array_join(F.collect_list(pair), ","), F.lit(',"note":5}')).alias("value"))
        body.repartition("day").write.partitionBy("day").text(f"{path}/{name}")
    docs = files.read_json_map(spark, f"{path}/docs", f"{path}/index")
    return docs.select(F.col("id").cast("bigint").alias("id"), F.get_json_object("doc", "$.cust").cast("bigint").alias("cust"), "hash")


@query("SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer")
def src_json_array_any(spark, sf_dir):
    """Arrays whose records run over several lines, several to a file."""
    path = folder(spark, "arrays")
    c = table(spark, sf_dir, "customer")
    record = F.to_json(F.struct("c_custkey", "c_name", "c_nationkey"), {"pretty": "true"})
    json_arrays.write_arrays(c.select(record), path, min(400, 1 + c.count() // 100))
    return json_arrays.read_json_array(spark, path, "c_custkey bigint, c_name string, c_nationkey bigint")


@query("SELECT doc_id, lang, md5(text) AS digest FROM documents")
def src_json_array_split(spark, sf_dir):
    """An array of up to 50,000 records in a file, with quotes, escapes and brackets in its texts, read by as many tasks as Spark splits it into."""
    path = folder(spark, "one-array")
    d = table(spark, sf_dir, "documents")
    odd = F.concat(F.lit('}"],[\\{'), F.col("text"))
    json_arrays.write_arrays(d.select(F.to_json(F.struct("doc_id", "lang", odd.alias("text")))), path, 1 + d.count() // 50_000)
    found = json_arrays.read_json_array(spark, path, "doc_id bigint, lang string, text string")
    return found.select("doc_id", "lang", F.md5(F.substring("text", 8, 1 << 30)).alias("digest"))


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def src_json_array(spark, sf_dir):
    path = folder(spark, "array")
    c = table(spark, sf_dir, "customer").select(F.concat(F.to_json(F.struct("c_custkey", "c_name", "c_mktsegment")), F.lit(",")).alias("value"))
    c.unionByName(spark.createDataFrame([("[",), ("]",)], "value string")).write.text(path)
    return files.read_json_array_lines(spark, path, "c_custkey bigint, c_name string, c_mktsegment string")


EVENT_DAYS = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("day", T.DateType())])


def _event_table(spark, sf_dir):
    path = folder(spark, "days")
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    sinks.write_days(e, path, EVENT_DAYS, "day", ["event_id"])
    return path


@query("SELECT CAST(ts AS DATE) AS day, event_id, event_type FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'")
def read_range(spark, sf_dir):
    return files.read_table(spark, _event_table(spark, sf_dir), EVENT_DAYS, "day", "2024-01-05", "2024-01-20", ["day", "event_id", "event_type"], ordered=True)


FEED = "struct<sequence_id:bigint,user:bigint,kind:string>"


@query("SELECT event_id AS sequence_id, user_id AS user, event_type AS kind FROM events WHERE event_id > 1000 AND event_id % 10 <> 3 AND event_id % 10 <> 7")
def feed_since(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    good = F.to_json(F.struct(F.col("event_id").alias("sequence_id"), F.col("user_id").alias("user"), F.col("event_type").alias("kind")))
    line = F.when(F.col("event_id") % 10 == 3, F.substring(good, 1, 20)).when(F.col("event_id") % 10 == 7, F.to_json(F.struct(F.lit("x").alias("sequence_id")))).otherwise(good)
    return files.since(files.read_feed(e.select(line.alias("value")), FEED).select("object.*"), 1000)


@query("SELECT p_name || '-' || p_partkey AS name, coalesce(CASE WHEN p_partkey % 3 = 0 THEN 'http://x/' || p_partkey END, 'http://base/' || p_name || '-' || p_partkey) AS url, CAST(p_size AS BIGINT) AS size FROM part WHERE p_partkey % 11 <> 0")
def listing_json(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    item = F.to_json(F.struct(F.when(F.col("p_partkey") % 11 != 0, F.concat_ws("-", "p_name", F.col("p_partkey").cast("string"))).alias("name"), F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("http://x/"), F.col("p_partkey").cast("string"))).alias("url"), F.col("p_size").alias("size")))
    arrays = p.groupBy(F.expr("p_partkey div 200").alias("k")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(item), ","), F.lit(",5]")).alias("a"))
    body = F.when(F.col("k") % 2 == 0, F.col("a")).otherwise(F.concat(F.lit('{"files":'), "a", F.lit("}")))
    return listings.parse_listing(arrays.select(body.alias("body")), base_url="http://base/").select("name", "url", "size")


@query("""SELECT page_id, CAST(i - 1 AS INT) AS position, h[i] AS href, l[i] AS label FROM (SELECT *, unnest(generate_series(1, len(h))) AS i FROM (
  SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS h, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS l FROM pages))""")
def page_links(spark, sf_dir):
    return listings.extract_links(table(spark, sf_dir, "pages").select("page_id", "html"))


@query("SELECT c_custkey // 100 AS page, c_custkey AS id FROM customer WHERE c_custkey % 7 > 1 AND c_custkey > 0")
def page_ids(spark, sf_dir):
    id_ = F.when(F.col("c_custkey") % 7 == 0, F.lit("x")).when(F.col("c_custkey") % 7 == 1, (-F.col("c_custkey")).cast("string")).otherwise(F.col("c_custkey").cast("string"))
    pages = table(spark, sf_dir, "customer").groupBy(F.expr("c_custkey div 100").alias("page")).agg(F.to_json(F.struct(F.collect_list(id_).alias("ids"))).alias("body"))
    return listings.parse_pages(pages)


def _day_counts(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))


@query("SELECT CAST(o_orderdate AS DATE) AS day, CAST(count(*) AS BIGINT) AS expected FROM orders GROUP BY 1")
def expected_counts(spark, sf_dir):
    pair = F.concat(F.lit('"'), F.date_format("day", "yyyyMMdd"), F.lit('":'), F.col("n").cast("string"))
    body = _day_counts(spark, sf_dir).groupBy(F.year("day")).agg(F.concat(F.lit('{"note":true,"x":1.5,'), F.array_join(F.collect_list(pair), ","), F.lit("}")).alias("body"))
    return listings.parse_counts(body.select("body"), fmt="yyyyMMdd")


@query("""WITH c AS (SELECT CAST(o_orderdate AS DATE) AS day, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1)
SELECT 'orders-' || day || '.csv.bz2' AS name, day AS logical_date, strftime(day, '%Y') || '/orders-' || day || '.csv.bz2' AS object_key, CASE WHEN day(day) % 3 <> 0 THEN n END AS expected_count,
  day(day) % 3 <> 0 AND day(day) % 2 = 0 AS listing_unchanged FROM c""")
def discover_objects(spark, sf_dir):
    c = _day_counts(spark, sf_dir)
    listing = c.select(F.concat(F.lit("orders-"), F.col("day").cast("string"), F.lit(".csv.bz2")).alias("name")).unionByName(c.select(F.concat(F.lit("readme-"), F.col("n").cast("string")).alias("name")))
    counts = c.filter(F.dayofmonth("day") % 3 != 0).select("day", F.col("n").alias("expected"))
    before = c.select("day", (F.col("n") + F.dayofmonth("day") % 2).alias("expected"))
    return listings.discover(listing, counts, r"orders-(\d{4}-\d{2}-\d{2})\.csv", previous=before).select("name", "logical_date", "object_key", "expected_count", "listing_unchanged")


# Nested documents


def _parsed(spark, sf_dir):
    return files.parse_documents(documents(spark, sf_dir), DOCUMENT)


@query(f"""WITH {LINES_SQL} SELECT o_orderkey AS id, o_custkey AS cust, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS time, CAST(o_orderdate AS DATE) AS order_day,
  CASE WHEN n > 0 THEN CAST((n + 2) // 3 AS INT) END AS n_boxes FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM l GROUP BY 1) ON l_orderkey = o_orderkey""")
def nest_header(spark, sf_dir):
    df = nested.flatten_header(_parsed(spark, sf_dir), {"id": "doc.id", "cust": "doc.party.cust", "status": "doc.party.status", "t": "doc.time"}, {"n_boxes": "doc.lines"}, "order_day")
    return df.withColumn("time", F.date_format(scalars.lenient_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss")).drop("t")


@query("SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS order_day, CAST(count(*) AS BIGINT) AS n_rows, (SELECT count(*) FROM orders) AS n_observed FROM orders GROUP BY 1")
def parse_counted(spark, sf_dir):
    """Headers staged with documents and rows counted in the job that writes them, then published by day."""
    header = T.StructType([T.StructField("id", T.LongType()), T.StructField("order_day", T.DateType())])

    def parse(docs):
        return nested.flatten_header(files.parse_documents(docs, DOCUMENT), {"id": "doc.id"}, day="order_day")

    docs = documents(spark, sf_dir).withColumn("order_day", F.trunc("order_day", "month"))
    staged, n = sinks.stage_counted(docs, parse, folder(spark, "staged"))
    path = folder(spark, "headers")
    sinks.write_days(staged, path, header, "order_day", ["id"])
    written = files.read_table(spark, path, header, "order_day")
    return written.groupBy("order_day").agg(F.count("*").alias("n_rows")).withColumn("n_observed", F.lit(n).cast("long"))


@query(f"WITH {LINES_SQL} SELECT l_orderkey AS id, CAST((rn + 2) // 3 AS INT) AS ordinal, l_partkey AS part, l_suppkey AS supp, l_quantity AS qty FROM l WHERE rn % 3 = 1 AND l_orderkey IN (SELECT o_orderkey FROM orders)")
def explode_children(spark, sf_dir):
    return nested.explode_ordinal(_parsed(spark, sf_dir), "doc.lines", ["doc.id"], {"part": "part", "supp": "supp", "qty": "qty"})


@query(f"""WITH {LINES_SQL} SELECT l_orderkey AS id, CASE WHEN rn % 3 <> 1 THEN CAST((rn + 2) // 3 AS INT) END AS parent_ordinal, CAST(CASE WHEN rn % 3 = 1 THEN (rn + 2) // 3 ELSE (rn - 1) % 3 END AS INT) AS ordinal,
  l_partkey AS part, l_suppkey AS supp, l_quantity AS qty FROM l WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""")
def explode_nested(spark, sf_dir):
    return explode_documents(documents(spark, sf_dir))


def explode_documents(docs):
    return nested.explode_two_levels(files.parse_documents(docs, DOCUMENT), "doc.lines", ["doc.id"], {"part": "part", "supp": "supp", "qty": "qty"}, "extra", f"array<{LINE}>".replace(">>", ",extra:string>>"))


@query("SELECT o_orderkey AS id, CAST(2 AS INT) AS violations FROM orders WHERE o_orderkey % 50 = 0")
def depth_violations(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    deep = F.lit('[{"part":1,"extra":[{"part":2}]},{"part":3,"extra":[{"part":4}]},{"part":5}]')
    extra = F.when(F.col("o_orderkey") % 50 == 0, deep).otherwise(F.lit('[{"part":1}]'))
    docs = o.select(F.struct(F.col("o_orderkey").alias("id"), F.array(F.struct(extra.alias("extra")), F.struct(F.lit(None).cast("string").alias("extra"))).alias("lines")).alias("doc"))
    return nested.depth_violations(docs, "doc.lines", ["doc.id"], "extra")


@query("""SELECT 'props' AS scope, 'k' AS key, CAST(count(*) AS BIGINT) AS documents FROM events
UNION ALL SELECT 'inner', 'odd', CAST(count(*) AS BIGINT) FROM events WHERE event_id % 2 = 1""")
def drift_keys(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    inner = F.array(F.lit('{"known":1}'), F.when(F.col("event_id") % 2 == 1, F.lit('{"odd":1,"known":2}')))
    return nested.unknown_keys(e, {"props": F.array("props"), "inner": inner}, {"props": [], "inner": ["known"]})


# Rows of feeds, snapshots and bodies


FEED_OBJECT = "struct<id:bigint,sequence_id:bigint,uploaded_at:string,hash:string,time:string,nested:struct<id:bigint>,meta:struct<hash:string,total:double,labels:array<bigint>>>"


def _feed_objects(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    odd = F.col("event_id") % 7 == 0
    meta = F.struct(F.md5("event_type").alias("hash"), F.col("value").alias("total"), F.array("user_id", "event_id").alias("labels"))
    time = F.when(F.col("event_id") % 13 == 0, F.lit("soon")).otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    obj = F.struct(F.when(~odd, F.col("event_id")).alias("id"), F.col("event_id").alias("sequence_id"), F.when(F.col("event_id") % 5 == 0, "later").otherwise((F.col("event_id") + 1700000000).cast("string")).alias("uploaded_at"), F.when(odd, F.lit("own")).alias("hash"), time.alias("time"), F.struct(F.col("event_id").alias("id")).alias("nested"), meta.alias("meta"))
    return files.read_feed(e.select(F.to_json(obj).alias("value")), FEED_OBJECT)


@query("""SELECT CASE WHEN event_id % 7 <> 0 THEN event_id END AS id, event_id AS sequence_id, CASE WHEN event_id % 5 <> 0 THEN strftime(to_timestamp(event_id + 1700000000) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') END AS uploaded,
  CASE WHEN event_id % 7 = 0 THEN 'own' ELSE md5(event_type) END AS hash, value AS total_value, user_id || ',' || event_id AS labels FROM events""")
def feed_metadata(spark, sf_dir):
    df = rows.feed_metadata(_feed_objects(spark, sf_dir))
    return df.withColumn("labels", F.array_join("labels", ",")).withColumn("uploaded", F.date_format("uploaded_at", "yyyy-MM-dd HH:mm:ss")).drop("uploaded_at")


@query("SELECT CASE WHEN event_id % 13 <> 0 THEN CAST(ts AS DATE) END AS day, CAST(count(*) AS BIGINT) AS n_objects, CAST(min(event_id) AS BIGINT) AS first_id FROM events GROUP BY 1")
def feed_day_split(spark, sf_dir):
    o = _feed_objects(spark, sf_dir).select(rows.event_day(F.col("object.time")).alias("day"), rows.first_id(F.col("object.id"), F.col("object.nested.id")).alias("id"))
    return o.groupBy("day").agg(F.count("*").alias("n_objects"), F.min("id").alias("first_id"))


@query("""SELECT c_custkey AS id, c_name AS name, c_custkey % 23 = 0 AS deleted, CASE WHEN c_custkey % 3 = 0 THEN '2003-03-12 20:04:00' WHEN c_custkey % 3 = 1 THEN '2010-11-02 20:05:00' END AS born,
  CASE WHEN c_custkey % 2 = 0 THEN '2024-02-01 10:00:00' ELSE '2024-03-01 00:00:00' END AS observed, 'snapshot' AS source FROM customer WHERE c_custkey % 17 <> 0""")
def entity_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    born = F.when(F.col("c_custkey") % 3 == 0, "2003-03-12 20:04:00+00").when(F.col("c_custkey") % 3 == 1, "2010-11-02T20:05:00.000Z").otherwise("unknown")
    raw = c.select(F.when(F.col("c_custkey") % 17 != 0, F.col("c_custkey")).alias("id"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 23 == 0, True).alias("deleted"), born.alias("birthday"), F.when(F.col("c_custkey") % 2 == 0, "2024-02-01T10:00:00Z").alias("updated"))
    df = rows.entity_rows(raw, "id", "2024-03-01", "snapshot", ["birthday"])
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return df.select("id", "name", "deleted", text("birthday").alias("born"), text("observed_at").alias("observed"), "source")


@query("SELECT o_custkey AS id, o_orderkey AS record_id, CASE WHEN o_orderkey % 10 <> 0 THEN o_orderstatus END AS value FROM orders WHERE o_orderkey % 19 <> 0")
def history_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    event = F.struct(F.when(F.col("o_orderkey") % 19 != 0, F.col("o_orderkey")).alias("record_id"), F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderstatus")).alias("value"))
    docs = o.groupBy(F.col("o_custkey").alias("id")).agg(F.to_json(F.collect_list(event)).alias("h"))
    return rows.history_rows(docs.select("id", F.from_json("h", "array<struct<record_id:bigint,value:string>>").alias("history")), "id")


@query("SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey % 5 <> 0 AND c_custkey % 7 <> 0")
def real_records(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    raw = c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_name")).alias("name"), F.when(F.col("c_custkey") % 7 == 0, "gone").alias("error"))
    return rows.real_records(raw).select("id", "name")


@query("""SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 4 <> 0 THEN CAST(c_nationkey AS BIGINT) END AS group_id, (c_custkey % 4 <> 0 AND c_nationkey = 3) OR c_custkey % 9 = 0 AS deleted FROM customer""")
def observation_rows(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    group = F.when(F.col("c_custkey") % 8 == 0, F.lit("true")).when(F.col("c_custkey") % 4 == 0, F.concat(F.lit('"x'), F.col("c_nationkey").cast("string"), F.lit('"'))).otherwise(F.col("c_nationkey").cast("string"))
    state = F.when(F.col("c_custkey") % 9 == 0, F.lit('"closed"')).otherwise(F.lit("null"))
    body = F.concat(F.lit('{"name":"'), "c_name", F.lit('","group":'), group, F.lit(',"state":'), state, F.lit("}"))
    df = rows.observation_rows(c.select(F.col("c_custkey").alias("id"), body.alias("body"), F.lit("2024-01-01").alias("observed_at")), "body", "id", 3, "observed_at")
    return df.drop("observed_at")


@query("SELECT l_orderkey AS id, string_agg(DISTINCT CAST(p AS VARCHAR), ',' ORDER BY CAST(p AS VARCHAR)) AS ids FROM (SELECT l_orderkey, l_partkey % 50 AS p FROM lineitem) WHERE p > 0 GROUP BY 1")
def body_ids(spark, sf_dir):
    bodies = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.to_json(F.collect_list(F.col("l_partkey") % 50)).alias("body"))
    ids = bodies.select("id", rows.json_body_ids(F.col("body")).alias("a")).filter("size(a) > 0")
    return ids.select("id", F.array_join(F.array_sort(F.transform("a", lambda x: x.cast("string"))), ",").alias("ids"))


# Merge of several sources


@query(f"WITH {SOURCES_SQL}, {MERGED_SQL} SELECT event_id, day, source, source_date, array_to_string(sources, ',') AS sources FROM merged")
def merge_precedence(spark, sf_dir):
    m = merge.merge_by_precedence(three_sources(spark, sf_dir), "event_id", "day", "source_date", ORDER_OF_SOURCES)
    return m.select("event_id", "day", "source", "source_date", F.array_join("sources", ",").alias("sources"))


@query(f"""WITH {SOURCES_SQL}, {MERGED_SQL} SELECT m.event_id, m.source, m.source_date, m.day, o.ordinal, m.user_id * 10 + length(m.source) + o.ordinal AS amount FROM merged m, (VALUES (1), (2)) o(ordinal)""")
def merge_children(spark, sf_dir):
    s = three_sources(spark, sf_dir)
    children = s.select("event_id", "source", "source_date", "user_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("ordinal")).withColumn("amount", F.col("user_id") * 10 + F.length("source") + F.col("ordinal")).drop("user_id")
    chosen = merge.merge_by_precedence(s, "event_id", "day", "source_date", ORDER_OF_SOURCES)
    return merge.children_of_chosen(children, chosen, "event_id")


@query("SELECT DISTINCT CAST(o_orderdate AS DATE) + i AS day FROM orders, (VALUES (-1), (0), (1)) s(i)")
def affected_days(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    return merge.affected_days(days)


@query(f"WITH {SOURCES_SQL}, {MERGED_SQL} SELECT source, CAST(source_date - day AS INT) AS spill, CAST(count(*) AS BIGINT) AS n_rows FROM merged GROUP BY ALL")
def merge_spill(spark, sf_dir):
    m = merge.merge_by_precedence(three_sources(spark, sf_dir), "event_id", "day", "source_date", ORDER_OF_SOURCES)
    return m.groupBy("source", F.datediff("source_date", "day").alias("spill")).agg(F.count("*").alias("n_rows"))


@query(f"WITH {SOURCES_SQL}, {MERGED_SQL} SELECT event_id, day, source, source_date FROM merged WHERE day BETWEEN DATE '2024-01-10' AND DATE '2024-01-15'")
def merge_range(spark, sf_dir):
    return merge.merge_range(three_sources(spark, sf_dir), "event_id", "day", "source_date", ORDER_OF_SOURCES, "2024-01-10", "2024-01-15").select("event_id", "day", "source", "source_date")


@query(f"""WITH {SOURCES_SQL}, {MERGED_SQL}, o AS (SELECT day, sources[1] AS s, count(*) AS n FROM merged WHERE len(sources) = 1 GROUP BY ALL)
SELECT day, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) FILTER (len(sources) > 1) AS BIGINT) AS n_shared, (SELECT string_agg(s || '=' || n, ',' ORDER BY s) FROM o WHERE o.day = merged.day) AS only FROM merged GROUP BY day""")
def merge_report(spark, sf_dir):
    return merge.merge_report(merge.merge_by_precedence(three_sources(spark, sf_dir), "event_id", "day", "source_date", ORDER_OF_SOURCES), "day")


@query(f"WITH {SOURCES_SQL}, p AS (SELECT DISTINCT day, source || '/' || source_date AS p FROM src WHERE abs(source_date - day) <= 1) SELECT day, string_agg(p, ',' ORDER BY p) AS built_from FROM p GROUP BY day")
def built_from(spark, sf_dir):
    return merge.built_from(three_sources(spark, sf_dir), "day", "source_date")


# Sinks


@query("SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1")
def write_days_roundtrip(spark, sf_dir):
    df = files.read_table(spark, _event_table(spark, sf_dir), EVENT_DAYS, "day")
    return df.groupBy("day").agg(F.count("*").alias("n_rows"), F.sum("event_id").alias("ids"))


@query("SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n_rows FROM events WHERE CAST(ts AS DATE) NOT IN (DATE '2024-01-03', DATE '2024-01-04') GROUP BY 1 UNION ALL SELECT DATE '2024-01-04', CAST(count(*) AS BIGINT) FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-04' AND event_id % 2 = 0")
def write_empties_day(spark, sf_dir):
    path = _event_table(spark, sf_dir)
    again = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")).filter("day IN (DATE '2024-01-04') AND event_id % 2 = 0")
    sinks.write_days(again, path, EVENT_DAYS, "day", ["event_id"], [datetime.date(2024, 1, 3), datetime.date(2024, 1, 4)])
    return files.read_table(spark, path, EVENT_DAYS, "day").groupBy("day").agg(F.count("*").alias("n_rows"))


@query("SELECT CAST(ts AS DATE) AS day, CAST(1 AS BIGINT) AS n_files, CAST(count(*) AS BIGINT) AS n_rows FROM events GROUP BY 1")
def partition_stats(spark, sf_dir):
    return sinks.partition_stats(spark, _event_table(spark, sf_dir), "day")


@query("SELECT 'events' AS table_name, CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n_rows, 'events' AS dataset, strftime(CAST(ts AS DATE), '%Y') || '/' || CAST(ts AS DATE) AS object_key, 1 AS revision, sha256(string_agg(event_id, ',' ORDER BY event_id)) AS sha256, 3 AS parser_version, CASE WHEN bool_or(event_id % 2 = 1) THEN 'k,odd' ELSE 'k' END AS unknown_keys FROM events GROUP BY 2")
def manifest(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    keys = F.array("props", F.when(F.col("event_id") % 2 == 1, F.lit('{"odd":1,"known":2}')))
    unknown = nested.unknown_keys_by_day(e, keys, ["known"], "day")
    hashes = e.groupBy("day").agg(F.sha2(F.array_join(F.sort_array(F.collect_list("event_id")), ",").cast("binary"), 256).alias("sha256"))
    stats = sinks.partition_stats(spark, _event_table(spark, sf_dir), "day")
    rows_ = sinks.manifest_rows(stats, "events", "day", "events", 1, 3, unknown=unknown, hashes=hashes)
    return rows_.withColumn("unknown_keys", F.array_join("unknown_keys", ",")).drop("built_from", "written_at")


@query("SELECT CAST(4 AS BIGINT) AS n_files, CAST(count(*) AS BIGINT) AS n_rows FROM customer")
def entity_export(spark, sf_dir):
    return sinks.export_table(table(spark, sf_dir, "customer"), folder(spark, "export"), ["c_custkey"], files=4)


# Live feed


def _feed(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_id").alias("sequence_id"), F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("key"), F.to_date("ts").alias("day"), "ts", "value")


@query("SELECT user_id || '/' || event_type AS key, CAST(max(event_id) AS BIGINT) AS sequence_id, arg_max(value, event_id) AS value FROM events GROUP BY 1")
def feed_newest(spark, sf_dir):
    return feed.newest_per_key(_feed(spark, sf_dir), ["key"], "sequence_id").select("key", "sequence_id", "value")


@query("SELECT event_id % 13 <> 0 AND event_id % 17 <> 0 AS usable, CAST(count(*) AS BIGINT) AS n_objects FROM events GROUP BY 1")
def feed_skipped(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 13 != 0, F.col("event_id")).alias("id"), F.when(F.col("event_id") % 17 != 0, F.to_date("ts")).alias("day"))
    return feed.split_skipped(e, ["id"], "day").groupBy("usable").agg(F.count("*").alias("n_objects"))


_REPLACED = """WITH x AS (SELECT user_id AS id, event_id AS seq, value FROM events WHERE event_id % 2 = 0 UNION ALL SELECT user_id, event_id, value FROM events WHERE event_id % 2 = 1)
SELECT id, CAST(max(seq) AS BIGINT) AS seq, arg_max(value, seq) AS value FROM x GROUP BY id"""


@query(_REPLACED)
def replace_keys(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("seq"), "value")
    a, b = (feed.newest_per_key(e.filter(f"seq % 2 = {k}"), ["id"], "seq") for k in (0, 1))
    return feed.replace_keys(a, b, ["id"], "seq", ["id"])


LIVE = T.StructType([T.StructField("key", T.StringType()), T.StructField("sequence_id", T.LongType()), T.StructField("value", T.DoubleType()), T.StructField("day", T.DateType())])
LIVE_LINE = "struct<key:string,sequence_id:bigint,value:double,day:date>"


def _flushed(spark, sf_dir, replays: int):
    source, path = folder(spark, "feed"), folder(spark, "live")
    e = _feed(spark, sf_dir).withColumn("key", F.concat_ws("/", "key", F.col("day").cast("string")))
    e.select(F.to_json(F.struct("key", "sequence_id", "value", "day")).alias("value")).repartitionByRange(6, F.get_json_object("value", "$.sequence_id").cast("bigint")).write.text(source)
    for i in range(replays):
        flush = feed.LiveFlush(path, LIVE, "key", "sequence_id", "day")
        flush.start(feed.feed_lines(spark, source, 3), lambda lines: feed.parsed_feed(lines, LIVE_LINE, "sequence_id"), folder(spark, f"checkpoint-{i}"), every=None).awaitTermination()
    return files.read_table(spark, path, LIVE, "day")


_LIVE_SQL = "SELECT user_id || '/' || event_type || '/' || CAST(ts AS DATE) AS key, CAST(ts AS DATE) AS day, CAST(max(event_id) AS BIGINT) AS sequence_id, arg_max(value, event_id) AS value FROM events GROUP BY ALL"


@query(_LIVE_SQL)
def live_flush(spark, sf_dir):
    return _flushed(spark, sf_dir, 1)


@query(_LIVE_SQL)
def live_flush_replay(spark, sf_dir):
    return _flushed(spark, sf_dir, 2)


ITEMS = T.StructType([T.StructField("key", T.StringType()), T.StructField("ordinal", T.IntegerType()), T.StructField("amount", T.LongType()), T.StructField("day", T.DateType())])


@query(f"WITH x AS ({_LIVE_SQL}), m AS (SELECT day, CAST(count(*) AS BIGINT) AS n_objects FROM x GROUP BY 1) SELECT key, day, CAST(o AS INT) AS ordinal, sequence_id * 10 + o AS amount, n_objects FROM x JOIN m USING (day), (VALUES (1), (2)) t(o) WHERE o <= sequence_id % 3")
def live_flush_children(spark, sf_dir):
    """Objects with items, flushed into two tables, and a count of each touched day written after each batch."""
    source, path = folder(spark, "feed"), folder(spark, "live")
    n_items = F.col("sequence_id") % 3
    e = _feed(spark, sf_dir).withColumn("key", F.concat_ws("/", "key", F.col("day").cast("string")))
    e = e.withColumn("items", F.slice(F.array(*[F.col("sequence_id") * 10 + i for i in (1, 2)]), F.lit(1), n_items.cast("int")))
    e.select(F.to_json(F.struct("key", "sequence_id", "value", "day", "items")).alias("value")).repartitionByRange(6, F.get_json_object("value", "$.sequence_id").cast("bigint")).write.text(source)

    def items(objects):
        return objects.select("key", "day", F.posexplode("items").alias("i", "amount")).withColumn("ordinal", (F.col("i") + 1).cast("int"))

    counts = T.StructType([T.StructField("n_objects", T.LongType()), T.StructField("day", T.DateType())])

    def merge_days(spark, days):
        live = files.read_table(spark, f"{path}/objects", LIVE, "day").join(days, "day", "left_semi")
        sinks.write_days(live.groupBy("day").agg(F.count("*").alias("n_objects")), f"{path}/merged", counts, "day", ["n_objects"])

    flush = feed.LiveFlush(f"{path}/objects", LIVE, "key", "sequence_id", "day", after=merge_days, children=[feed.Child(f"{path}/items", ITEMS, ["key", "ordinal"], items)])
    line = LIVE_LINE.replace(">", ",items:array<bigint>>")
    flush.start(feed.feed_lines(spark, source, 3), lambda lines: feed.parsed_feed(lines, line, "sequence_id"), folder(spark, "checkpoint"), every=None).awaitTermination()
    merged = files.read_table(spark, f"{path}/merged", counts, "day")
    return files.read_table(spark, f"{path}/items", ITEMS, "day").join(merged, "day").select("key", "day", "ordinal", "amount", "n_objects")


_MERGED_LIVE = """WITH s AS (
  SELECT event_id, CAST(ts AS DATE) AS day, 'a' AS source FROM events WHERE event_id % 3 <> 0 UNION ALL SELECT event_id, CAST(ts AS DATE), 'live' FROM events WHERE event_id % 2 = 0
),
m AS (SELECT event_id, day, min(source) AS source, string_agg(source, ',' ORDER BY source) AS sources FROM s WHERE day IN (SELECT day FROM s WHERE source = 'live') GROUP BY ALL)"""
FACT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("sequence_id", T.LongType()), T.StructField("value", T.DoubleType()), T.StructField("day", T.DateType())])
PART = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("ordinal", T.IntegerType()), T.StructField("amount", T.LongType()), T.StructField("day", T.DateType())])
META = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("hash", T.StringType()), T.StructField("labels", T.ArrayType(T.StringType())), T.StructField("day", T.DateType())])


def _merged_live(spark, sf_dir):
    """A source written by day, a live feed flushed beside it with two child tables and metadata, and the merge of touched days."""
    root, source = folder(spark, "layers"), folder(spark, "feed")
    of = layers.Layers(root, ["a", "live"], "event_id", FACT, {"parts": (PART, ["event_id", "ordinal"]), "notes": (PART, ["event_id", "ordinal"])})
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts")).withColumn("sequence_id", F.col("event_id"))
    a = e.filter("event_id % 3 <> 0")
    files_ = sinks.files_for(*a.agg(F.count("*"), F.countDistinct("day")).first())
    sinks.write_days(a, of.source_path("a", "objects"), FACT, "day", ["event_id"], files=files_)
    for name, k in (("parts", 2), ("notes", 1)):
        rows_ = a.withColumn("ordinal", F.explode(F.sequence(F.lit(1), F.lit(k)))).withColumn("amount", F.col("event_id") * 100 + F.col("ordinal"))
        sinks.write_days(rows_, of.source_path("a", name), PART, "day", ["event_id", "ordinal"], files=files_)
    items = lambda k: F.transform(F.sequence(F.lit(1), F.lit(k)), lambda i: F.struct((F.col("event_id") * 10 + i).alias("amount")))
    odd = F.when(F.col("event_id") % 4 == 0, F.lit(1)).alias("odd")
    line = F.to_json(F.struct("event_id", "sequence_id", "value", "day", items(3).alias("parts"), items(1).alias("notes"), F.struct(F.md5("event_type").alias("hash"), F.array("user_id").alias("labels")).alias("meta"), odd))
    e.filter("event_id % 2 = 0").select(line.alias("value"), "event_id").repartitionByRange(6, "event_id").select("value").write.text(source)

    def child(name):
        def rows_of(objects):
            return nested.explode_ordinal(objects, name, ["event_id", "day"], {"amount": "amount"})

        return feed.Child(of.source_path("live", name), PART, ["event_id", "ordinal"], rows_of)

    def metadata(objects):
        return objects.select("event_id", F.col("meta.hash").alias("hash"), F.transform("meta.labels", lambda x: x.cast("string")).alias("labels"), "day")

    def drift(batch):
        return nested.unknown_keys(batch, {"top": F.array("text")}, {"top": ["event_id", "sequence_id", "value", "day", "parts", "notes", "meta"]})

    def parse(lines):
        schema = "struct<event_id:bigint,sequence_id:bigint,value:double,day:date,parts:array<struct<amount:bigint>>,notes:array<struct<amount:bigint>>,meta:struct<hash:string,labels:array<bigint>>>"
        return files.read_feed(lines, schema).select("object.*", F.col("value").alias("text"))

    flush = feed.LiveFlush(
        of.source_path("live", "objects"), FACT, "event_id", "sequence_id", "day", drift=(f"{root}/drift", drift),
        children=[child("parts"), child("notes"), feed.Child(f"{root}/metadata", META, ["event_id"], metadata)],
        after=lambda spark, days: of.rebuild(spark, [r[0] for r in days.collect()]),
    )
    flush.start(feed.feed_lines(spark, source, 3), parse, folder(spark, "checkpoint"), every=None).awaitTermination()
    return of, root


@query(f"""{_MERGED_LIVE} SELECT m.event_id, m.day, m.source, m.sources, t.name, CAST(o AS INT) AS ordinal, m.event_id * (CASE WHEN m.source = 'a' THEN 100 ELSE 10 END) + o AS amount
FROM m, (VALUES ('parts', 'a', 1), ('parts', 'a', 2), ('parts', 'live', 1), ('parts', 'live', 2), ('parts', 'live', 3), ('notes', 'a', 1), ('notes', 'live', 1)) t(name, source, o) WHERE t.source = m.source""")
def live_flush_merged(spark, sf_dir):
    of, _ = _merged_live(spark, sf_dir)
    chosen = of.read_merged(spark, "objects").select("event_id", "day", "source", F.array_join("sources", ",").alias("sources"))
    parts, notes = (of.read_merged(spark, n).select("event_id", F.lit(n).alias("name"), "ordinal", "amount") for n in ("parts", "notes"))
    return chosen.join(parts.unionByName(notes), "event_id")


@query("SELECT event_id, CAST(ts AS DATE) AS day, md5(event_type) AS hash, CAST(user_id AS VARCHAR) AS labels, (SELECT count(*) FROM events WHERE event_id % 4 = 0) AS n_odd FROM events WHERE event_id % 2 = 0")
def live_flush_metadata(spark, sf_dir):
    _, root = _merged_live(spark, sf_dir)
    odd = spark.read.parquet(f"{root}/drift").filter("scope = 'top' AND key = 'odd'").agg(F.sum("documents")).first()[0]
    meta = files.read_table(spark, f"{root}/metadata", META, "day").withColumn("labels", F.array_join("labels", ","))
    return meta.withColumn("n_odd", F.lit(odd).cast("long"))


@query("SELECT event_id - 1 AS after, event_id + 1 AS before, CAST(1 AS BIGINT) AS missing FROM events WHERE event_id % 7 = 3 AND event_id < (SELECT max(event_id) FROM events)")
def sequence_gaps(spark, sf_dir):
    holes = _feed(spark, sf_dir).filter("sequence_id % 7 <> 3")  # the gaps to be found
    return feed.sequence_gaps(holes, "sequence_id", "ts", "2030-01-01")


@query("SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n_objects, CAST(max(event_id) AS BIGINT) AS newest_sequence, CAST(30.0 AS DOUBLE) AS lag_s FROM events GROUP BY 1")
def feed_status(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("uploaded", F.col("ts") - F.expr("INTERVAL 30 SECONDS"))
    return feed.feed_status(e, "event_id", "uploaded", "ts").drop("last_upload")


@query("""WITH e AS (SELECT event_id AS s, ts FROM events WHERE event_id % 7 <> 3), g AS (SELECT lag(s) OVER (ORDER BY s) AS after, s AS before, ts FROM e)
SELECT after, before, CAST(before - after - 1 AS BIGINT) AS missing FROM g WHERE before - after > 1 AND ts <= (SELECT max(ts) FROM e) - INTERVAL 2 MINUTE""")
def live_gaps(spark, sf_dir):
    """Gaps told by a stream that gets some objects late and others twice, less those withdrawn."""
    source, path = folder(spark, "gap-feed"), folder(spark, "gaps")
    e = table(spark, sf_dir, "events").filter("event_id % 7 <> 3").select(F.col("event_id").alias("s"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("t"))
    arrival = F.col("s") + F.when(F.col("s") % 11 == 0, 5000).otherwise(0)  # some come much later
    landed = e.withColumn("a", F.explode(F.when(F.col("s") % 5 == 0, F.array(arrival, arrival + 2000)).otherwise(F.array(arrival))))
    k = 1 + e.count() // 2_000_000  # so that no file grows with the table
    landed.repartitionByRange(6 * k, "a").select("s", "t").write.json(source)
    stream = spark.readStream.schema("s long, t timestamp").option("maxFilesPerTrigger", k).json(source)
    gaps.start(gaps.gap_stream(stream, "s", "t"), path, folder(spark, "gap-checkpoint"), every=None).awaitTermination()
    told = spark.read.schema(gaps.TOLD).parquet(path)
    return gaps.open_gaps(told).select("after", "before", "missing")


@query("SELECT event_id AS sequence, user_id AS user, event_type AS kind FROM events")
def live_sequences(spark, sf_dir):
    """A feed landed in two parts, some objects twice, read by two runs of a stream from one checkpoint."""
    source, path, checkpoint = folder(spark, "sequences"), folder(spark, "sequence-rows"), folder(spark, "sequence-checkpoint")
    e = table(spark, sf_dir, "events")
    half = e.agg(F.max("event_id")).first()[0] // 2
    line = F.to_json(F.struct(F.col("event_id").alias("sequence_id"), F.col("user_id").alias("user"), F.col("event_type").alias("kind"))).alias("value")
    for part in (e.filter(F.col("event_id") <= half), e.filter((F.col("event_id") > half) | (F.col("event_id") % 10 == 0))):
        sequence_feed.land(part.select(line), source, 4096)
        rows_ = sequence_feed.read_sequences(spark, source, 4096).select("sequence", F.from_json("value", "user bigint, kind string").alias("o")).select("sequence", "o.*")
        rows_.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("sequence long, user long, kind string").parquet(path)
