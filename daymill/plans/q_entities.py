"""Upserts, entity reads, differences of snapshots and the work queue over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import entities, workqueue
from ._register import registry
from .inputs import AFFILIATES_SQL, BASE_SQL, HISTORY_SQL, QUEUE_SQL, base_snapshot, history, incoming_snapshot, queue, table

query, QUERIES, ORACLES = registry()
NOW = "1998-06-01"


def _text(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


_UPSERT = f"""WITH {BASE_SQL}, u AS (SELECT *, 0 AS side FROM base UNION ALL SELECT *, 1 FROM incoming)
SELECT id, name, title, strftime(observed_at, '%Y-%m-%d %H:%M:%S') AS observed_at, source FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY observed_at DESC, side DESC) = 1"""


@query(_UPSERT)
def upsert_newer(spark, sf_dir):
    out = entities.upsert_newer(base_snapshot(spark, sf_dir), incoming_snapshot(spark, sf_dir), ["id"], required=["name"])
    return out.select("id", "name", "title", _text("observed_at"), "source")


@query(_UPSERT)
def seed_all(spark, sf_dir):
    parts = [incoming_snapshot(spark, sf_dir).filter(f"id % 3 = {k}") for k in (2, 0, 1)]
    return entities.seed_all(base_snapshot(spark, sf_dir), parts, ["id"]).select("id", "name", "title", _text("observed_at"), "source")


@query("SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def entity_lookup(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return entities.lookup(c, table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id")), "id")


def _affiliates(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("group_id"), (F.col("c_nationkey") % 5).alias("parent_id"), F.col("c_mktsegment").alias("title"), (F.col("c_custkey") % 23 == 0).alias("deleted"))


@query(f"WITH {AFFILIATES_SQL} SELECT id FROM snap WHERE NOT deleted AND group_id = 3 AND id < 900 ORDER BY id DESC LIMIT 20")
def id_page(spark, sf_dir):
    return entities.id_page(_affiliates(spark, sf_dir), "id", live_only=True, where={"group_id": 3}, after=900, descending=True, limit=20)


@query("SELECT CAST(count(*) AS BIGINT) AS n_rows FROM customer")
def entity_counts(spark, sf_dir):
    return table(spark, sf_dir, "customer").agg(F.count("*").alias("n_rows"))


@query(f"WITH {HISTORY_SQL} SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY id ORDER BY start_date DESC, record_id DESC) = 1")
def latest_record(spark, sf_dir):
    return entities.latest_per_entity(history(spark, sf_dir), "id")


@query(f"WITH {HISTORY_SQL} SELECT id, value FROM h QUALIFY row_number() OVER (PARTITION BY id ORDER BY start_date DESC, record_id DESC) = 1")
def latest_value(spark, sf_dir):
    return entities.latest_value(history(spark, sf_dir), "id", "value")


@query(f"""WITH {HISTORY_SQL}, n AS (SELECT id, value FROM h QUALIFY row_number() OVER (PARTITION BY id ORDER BY start_date DESC, record_id DESC) = 1)
SELECT id, 'O' AS current_value, value AS history_value FROM n JOIN customer ON id = c_custkey WHERE value IS DISTINCT FROM 'O'""")
def history_mismatch(spark, sf_dir):
    now = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.lit("O").alias("value"))
    return entities.history_mismatch(now, history(spark, sf_dir), "id", "value")


_FACT_IDS = """ids AS (SELECT 'customer' AS kind, o_custkey AS id FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31' AND o_custkey > 0
  UNION SELECT 'part', l_partkey FROM lineitem WHERE l_partkey > 0 UNION SELECT 'supplier', l_suppkey FROM lineitem WHERE l_suppkey > 0)"""


def _fact_ids(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return entities.ids_from_facts([(o, {"o_custkey": "customer"}), (table(spark, sf_dir, "lineitem"), {"l_partkey": "part", "l_suppkey": "supplier"})], "day", "1996-01-01", "1997-12-31")


@query(f"WITH {_FACT_IDS} SELECT * FROM ids")
def ids_from_facts(spark, sf_dir):
    return _fact_ids(spark, sf_dir)


@query(f"WITH {_FACT_IDS} SELECT kind, id FROM ids WHERE NOT (kind = 'customer' AND id IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0)) AND NOT (kind = 'part' AND id IN (SELECT p_partkey FROM part WHERE p_size > 5))")
def unknown_ids(spark, sf_dir):
    c = table(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"))
    p = table(spark, sf_dir, "part").filter("p_size > 5").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"))
    return entities.unknown_ids(_fact_ids(spark, sf_dir), c.unionByName(p))


@query("SELECT DISTINCT o_custkey AS id FROM orders WHERE o_custkey > 100")
def new_since(spark, sf_dir):
    return entities.new_since(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("id")), "id", 100)


_AFFILIATION = f"""WITH {AFFILIATES_SQL}, r AS (
  SELECT c_custkey AS id, c_custkey % 31 <> 0 AS valid, CASE WHEN c_custkey % 13 = 0 THEN (c_nationkey + 1) % 25 WHEN c_custkey % 17 = 0 THEN 7 ELSE c_nationkey END AS group_id,
    CASE WHEN c_custkey % 29 = 0 THEN 77 ELSE c_nationkey % 5 END AS parent_id, CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS title FROM customer),
s AS (SELECT * FROM snap WHERE id % 19 <> 0),
k AS (SELECT r.id, r.group_id, r.parent_id, r.title, s.group_id AS old_group, s.parent_id AS old_parent, s.title AS old_title, s.deleted,
  CASE WHEN NOT valid THEN CASE WHEN s.id IS NOT NULL AND NOT s.deleted THEN 'invalid' ELSE 'same' END WHEN s.id IS NULL THEN 'unknown'
    WHEN r.group_id = 7 THEN CASE WHEN NOT s.deleted OR s.group_id IS DISTINCT FROM 7 THEN 'moved_to_deleted' ELSE 'same' END
    WHEN r.group_id IS DISTINCT FROM s.group_id OR s.deleted THEN 'restored_or_moved'
    WHEN r.parent_id IS DISTINCT FROM s.parent_id OR r.title IS DISTINCT FROM s.title THEN 'attributes_only' ELSE 'same' END AS class
  FROM r LEFT JOIN s ON r.id = s.id)"""


def _affiliation(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    group = F.when(F.col("c_custkey") % 13 == 0, (F.col("c_nationkey") + 1) % 25).when(F.col("c_custkey") % 17 == 0, 7).otherwise(F.col("c_nationkey"))
    parent = F.when(F.col("c_custkey") % 29 == 0, 77).otherwise(F.col("c_nationkey") % 5)
    r = c.select(F.col("c_custkey").alias("id"), (F.col("c_custkey") % 31 != 0).alias("valid"), group.alias("group_id"), parent.alias("parent_id"), F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("title"))
    stored = _affiliates(spark, sf_dir).filter("id % 19 <> 0")
    return entities.classify_affiliation(r, stored, "id", 7), stored


@query(f"{_AFFILIATION} SELECT id, class, class IN ('unknown', 'restored_or_moved') AS changed FROM k")
def affiliation_diff(spark, sf_dir):
    return _affiliation(spark, sf_dir)[0].select("id", "class", "changed")


@query(f"""{_AFFILIATION} SELECT id, CASE class WHEN 'moved_to_deleted' THEN 7 WHEN 'restored_or_moved' THEN group_id ELSE old_group END AS group_id,
  CASE class WHEN 'moved_to_deleted' THEN NULL WHEN 'invalid' THEN old_parent ELSE parent_id END AS parent_id,
  CASE class WHEN 'moved_to_deleted' THEN NULL WHEN 'invalid' THEN old_title ELSE title END AS title,
  CASE class WHEN 'restored_or_moved' THEN false WHEN 'attributes_only' THEN deleted ELSE true END AS deleted FROM k WHERE class NOT IN ('same', 'unknown')""")
def affiliation_rows(spark, sf_dir):
    classified, stored = _affiliation(spark, sf_dir)
    return entities.affiliation_rows(classified, stored, "id")


@query("SELECT DISTINCT c_nationkey AS parent_id FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 4 = 0)")
def unknown_parents(spark, sf_dir):
    return entities.unknown_parents(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("parent_id")), table(spark, sf_dir, "nation").filter("n_nationkey % 4 = 0").select(F.col("n_nationkey").alias("parent_id")))


@query(f"""{_AFFILIATION.replace("SELECT r.id,", "SELECT r.valid, r.id,")} SELECT DISTINCT parent_id FROM k WHERE valid AND (class = 'unknown' OR group_id <> 7) AND parent_id NOT IN (SELECT r_regionkey FROM region WHERE r_regionkey % 2 = 0)""")
def affiliation_parents(spark, sf_dir):
    """Parents to be read for the first time, without those of refused and closed results."""
    classified, _ = _affiliation(spark, sf_dir)
    stored = table(spark, sf_dir, "region").filter("r_regionkey % 2 = 0").select(F.col("r_regionkey").alias("parent_id"))
    return entities.unknown_parents(classified, stored, closed_group=7)


def _entries(spark, sf_dir, kind):
    """A work queue of the customers: a third has no entry, the others were refreshed at one of two times or never."""
    at = F.when(F.col("c_custkey") % 2 == 0, F.lit("2024-01-01")).when(F.col("c_custkey") % 5 != 0, F.lit("2024-03-01")).cast("timestamp_ntz")
    return table(spark, sf_dir, "customer").filter("c_custkey % 3 <> 0").select(F.lit(kind).alias("kind"), F.col("c_custkey").alias("entity_id"), at.alias("last_refreshed_at"))


#: Whether _entries has the id as stale: without an entry, never refreshed, or refreshed before February.
_STALE = "({0} % 3 = 0 OR {0} % 2 = 0 OR {0} % 5 = 0)"


@query(f"""WITH st AS (SELECT c_nationkey AS group_id, c_custkey AS member_id FROM customer WHERE c_custkey % 19 <> 0),
li AS (SELECT CASE WHEN c_custkey % 13 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS group_id, c_custkey AS member_id FROM customer WHERE c_custkey % 17 <> 0)
SELECT * FROM (SELECT li.group_id, li.member_id, CASE WHEN st.member_id IS NULL THEN 'unknown' WHEN st.group_id <> li.group_id THEN 'joined' WHEN {_STALE.format("li.member_id")} THEN 'active' END AS change FROM li LEFT JOIN st USING (member_id)) WHERE change IS NOT NULL
UNION ALL SELECT group_id, member_id, 'left' FROM st WHERE group_id IN (SELECT group_id FROM li) AND NOT EXISTS (SELECT 1 FROM li WHERE li.group_id = st.group_id AND li.member_id = st.member_id)""")
def membership_diff(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    stored = c.filter("c_custkey % 19 <> 0").select(F.col("c_nationkey").alias("group_id"), F.col("c_custkey").alias("member_id"))
    listed = c.filter("c_custkey % 17 <> 0").select(F.when(F.col("c_custkey") % 13 == 0, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey")).alias("group_id"), F.col("c_custkey").alias("member_id"))
    return entities.membership_diff(listed, stored, "group_id", "member_id", _entries(spark, sf_dir, "member"), "member", "2024-02-01")


@query(f"""SELECT id, change FROM (SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 23 <> 0 THEN 'closed' END
  WHEN c_custkey % 7 = 0 THEN 'new' WHEN {_STALE.format("c_custkey")} THEN 'active' END AS change FROM customer) WHERE change IS NOT NULL""")
def group_diff(spark, sf_dir):
    a = _affiliates(spark, sf_dir)
    return entities.group_diff(a.filter("id % 5 <> 0").select("id"), a.filter("id % 7 <> 0"), "id", _entries(spark, sf_dir, "group"), "group", "2024-02-01")


@query("SELECT c_custkey AS id, c_custkey % 23 = 0 OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS deleted FROM customer")
def mark_deleted(spark, sf_dir):
    a = _affiliates(spark, sf_dir).withColumn("observed_at", F.lit("2024-01-01").cast("timestamp"))
    gone = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id"))
    return entities.mark_deleted(a, gone, "id", "2024-02-01").select("id", "deleted")


@query("""SELECT 'top' AS kind, CAST(r_regionkey AS BIGINT) AS id FROM region WHERE r_regionkey < 2 UNION ALL SELECT 'group', CAST(n_nationkey AS BIGINT) FROM nation WHERE n_regionkey < 2
UNION ALL SELECT 'member', c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey < 2""")
def expand_members(spark, sf_dir):
    r = table(spark, sf_dir, "region").filter("r_regionkey < 2").select(F.col("r_regionkey").alias("top_id"))
    n = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("top_id"), F.col("n_nationkey").alias("group_id"))
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("group_id"), F.col("c_custkey").alias("member_id"))
    return entities.expand_members(r, n, c, "top_id", "group_id", "member_id")


@query("""SELECT c_name AS name, c_custkey AS id, true AS matched FROM customer UNION ALL SELECT 'nobody ' || c_custkey, NULL, false FROM customer""")
def resolve_names(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    asked = c.select(F.explode(F.array(F.concat(F.lit(" "), "c_name"), F.lower("c_name"), F.concat(F.lit("nobody "), F.col("c_custkey").cast("string")), F.lit("  "))).alias("name"))
    return entities.resolve_names(asked, c.select(F.col("c_name").alias("name"), "c_custkey"), "c_custkey")


@query("SELECT CAST(max(CAST(ts AS DATE)) AS DATE) AS logical_date FROM events")
def latest_snapshot(spark, sf_dir):
    return entities.choose_snapshots(table(spark, sf_dir, "events").select(F.to_date("ts").alias("logical_date")).distinct(), "latest")


@query(f"WITH {AFFILIATES_SQL} SELECT id FROM snap WHERE deleted AND group_id = 3 AND id > 10 ORDER BY id LIMIT 1000")
def recheck_candidates(spark, sf_dir):
    return entities.recheck_candidates(_affiliates(spark, sf_dir), "id", "deleted", 3, cursor=10)


# The work queue


_ENTRIES_SQL = "en AS (SELECT o_orderstatus AS kind, o_orderkey * 2 AS entity_id, 2 AS priority, TIMESTAMP '1997-01-01' AS next_due_at FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderstatus, o_orderkey, 4, TIMESTAMP '1996-01-01' FROM orders WHERE o_orderkey % 5 = 0)"


@query(f"""WITH {QUEUE_SQL}, {_ENTRIES_SQL}, b AS (SELECT kind, entity_id, min(priority) AS p, min(next_due_at) AS d FROM en GROUP BY ALL)
SELECT kind, entity_id, least(priority, p) AS priority, strftime(least(next_due_at, d), '%Y-%m-%d %H:%M:%S') AS next_due_at, coalesce(failures, 0) AS failures FROM q FULL JOIN b USING (kind, entity_id)""")
def queue_push(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    a = o.filter("o_orderkey % 2 = 0").select(F.col("o_orderstatus").alias("kind"), (F.col("o_orderkey") * 2).alias("entity_id"), F.lit(2).alias("priority"), F.lit("1997-01-01").cast("timestamp_ntz").alias("next_due_at"))
    b = o.filter("o_orderkey % 5 = 0").select(F.col("o_orderstatus").alias("kind"), F.col("o_orderkey").alias("entity_id"), F.lit(4).alias("priority"), F.lit("1996-01-01").cast("timestamp_ntz").alias("next_due_at"))
    return workqueue.push(queue(spark, sf_dir), a.unionByName(b)).select("kind", "entity_id", "priority", _text("next_due_at"), "failures")


_TAKE = f"""{QUEUE_SQL}, t AS (SELECT *, row_number() OVER (PARTITION BY priority, kind ORDER BY last_refreshed_at NULLS FIRST, next_due_at, entity_id) AS turn FROM q WHERE next_due_at <= TIMESTAMP '{NOW}')"""


@query(f"WITH {_TAKE} SELECT kind, entity_id, priority, CAST(turn AS INT) AS turn FROM t ORDER BY priority, turn, next_due_at, kind LIMIT 500")
def queue_take(spark, sf_dir):
    return workqueue.take(queue(spark, sf_dir), NOW, 500).select("kind", "entity_id", "priority", "turn")


@query(f"WITH {QUEUE_SQL} SELECT i.kind, i.entity_id FROM (SELECT o_orderstatus AS kind, o_orderkey + 5000 AS entity_id FROM orders) i LEFT JOIN q USING (kind, entity_id) WHERE q.priority IS NULL OR q.last_refreshed_at IS NULL OR q.last_refreshed_at < TIMESTAMP '1996-01-01'")
def queue_filter(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("kind"), (F.col("o_orderkey") + 5000).alias("entity_id"))
    return workqueue.worth_queueing(ids, queue(spark, sf_dir), "1996-01-01")


@query(f"WITH {QUEUE_SQL} SELECT priority, CAST(count(*) AS BIGINT) AS n_entries, CAST(count(*) FILTER (next_due_at <= TIMESTAMP '{NOW}') AS BIGINT) AS n_due FROM q GROUP BY 1")
def queue_counts(spark, sf_dir):
    return workqueue.counts(queue(spark, sf_dir), NOW)


@query(f"WITH {QUEUE_SQL} SELECT kind, entity_id, CASE WHEN priority = 5 AND (entity_id % 4 = 0 OR entity_id % 9 = 0) THEN 8 ELSE priority END AS priority FROM q")
def queue_defer(spark, sf_dir):
    q = queue(spark, sf_dir)
    return workqueue.defer(q, q.filter("entity_id % 9 <> 0").select("kind", "entity_id", (F.col("entity_id") % 4 == 0).alias("deleted")), 5).select("kind", "entity_id", "priority")


@query(f"""WITH {_TAKE}, s AS (SELECT *, sum(CASE WHEN kind IN ('O', 'F') AND NOT (priority IN (2, 5) AND entity_id % 2 = 0) THEN 2 ELSE 1 END) OVER (ORDER BY priority, turn, next_due_at, kind ROWS UNBOUNDED PRECEDING) AS spent FROM t)
SELECT kind, entity_id, CAST(spent AS BIGINT) AS spent FROM s WHERE spent <= 5000""")
def queue_within_budget(spark, sf_dir):
    q = queue(spark, sf_dir)
    stored = q.filter("entity_id % 2 = 0").select("kind", "entity_id")
    return workqueue.within_budget(q, NOW, 5000, {"O": 2, "F": 2}, stored, light=(2, 5)).select("kind", "entity_id", "spent")


#: By entity_id % 8; 403 and 420 leave the entry alone, 408, 429 and 503 are tried again, 404 and 400 are parked.
_STATUS = (200, 404, 503, 429, 403, 408, 420, 400)


@query(f"""WITH {QUEUE_SQL}, o AS (SELECT *, list_extract({list(_STATUS)}, CAST(entity_id % 8 + 1 AS BIGINT)) AS status, entity_id % 9 <> 0 AS asked FROM q),
c AS (SELECT *, CASE WHEN NOT asked OR status IN (403, 420) THEN 'none' WHEN status = 200 THEN 'ok' WHEN status IN (404, 400) THEN 'parked' ELSE 'again' END AS outcome FROM o)
SELECT kind, entity_id, CASE WHEN outcome IN ('ok', 'parked') THEN 9 ELSE priority END AS priority, CASE outcome WHEN 'none' THEN failures WHEN 'ok' THEN 0 ELSE failures + 1 END AS failures,
  strftime(CASE outcome WHEN 'none' THEN next_due_at WHEN 'ok' THEN TIMESTAMP '2024-01-01' + INTERVAL 3650 DAY WHEN 'parked' THEN TIMESTAMP '2024-01-01' + INTERVAL 365 DAY ELSE TIMESTAMP '2024-01-01' + to_hours(CAST(least(pow(2, failures), 24) AS BIGINT)) END, '%Y-%m-%d %H:%M:%S') AS next_due_at,
  CASE outcome WHEN 'none' THEN last_error WHEN 'ok' THEN NULL ELSE 'HTTP ' || status END AS last_error FROM c""")
def queue_apply(spark, sf_dir):
    q = queue(spark, sf_dir)
    status = F.element_at(F.array(*map(F.lit, _STATUS)), (F.col("entity_id") % 8 + 1).cast("int"))
    done = q.filter("entity_id % 9 <> 0").select("kind", "entity_id", F.lit("2024-01-01").cast("timestamp_ntz").alias("at"), status.alias("status")).withColumn("error", F.concat(F.lit("HTTP "), F.col("status").cast("string")))
    return workqueue.apply_outcomes(q, done).select("kind", "entity_id", "priority", "failures", _text("next_due_at"), "last_error")


#: Customers and suppliers as the crawl's entities; some have an entry, of which few of the crawl class (5) are due.
_CRAWL = """live AS (SELECT 'customer' AS kind, c_custkey AS entity_id FROM customer UNION ALL SELECT 'supplier', s_suppkey FROM supplier),
en AS (SELECT kind, entity_id, CASE WHEN entity_id % 20 = 0 THEN 5 ELSE 1 END AS priority, CASE WHEN entity_id % 20 = 0 THEN TIMESTAMP '2030-01-01' ELSE TIMESTAMP '2020-01-01' END AS next_due_at FROM live WHERE entity_id % 10 = 0)"""


def _crawl(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("entity_id"))
    live = c.unionByName(table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("entity_id")))
    late = F.col("entity_id") % 20 == 0
    entries = live.filter("entity_id % 10 = 0").select("*", F.when(late, 5).otherwise(1).alias("priority"), F.lit(None).cast("timestamp_ntz").alias("last_refreshed_at"), F.when(late, F.lit("2030-01-01")).otherwise("2020-01-01").cast("timestamp_ntz").alias("next_due_at"))
    return live, entries


@query(f"""WITH {_CRAWL}, f AS (SELECT 'customer' AS kind, o_custkey AS entity_id FROM orders UNION SELECT 'supplier', l_suppkey FROM lineitem)
SELECT kind, entity_id FROM f WHERE (kind, entity_id) NOT IN (SELECT (kind, entity_id) FROM en) AND (SELECT count(*) FROM en WHERE priority = 5 AND next_due_at <= TIMESTAMP '2024-01-01') < 10""")
def crawl_feed(spark, sf_dir):
    _, entries = _crawl(spark, sf_dir)
    o, l = (table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    facts = entities.ids_from_facts([(o, {"o_custkey": "customer"}), (l, {"l_suppkey": "supplier"})]).withColumnRenamed("id", "entity_id")
    return workqueue.crawl_facts(entries, facts, "2024-01-01", 5, 10)


@query(f"""WITH {_CRAWL}, r AS (SELECT kind, entity_id, (row_number() OVER (PARTITION BY kind ORDER BY entity_id DESC) - 1) // 7 AS page, en.priority IS NULL AS wanted FROM live LEFT JOIN en USING (kind, entity_id) WHERE NOT (kind = 'supplier' AND entity_id >= 9)),
w AS (SELECT kind, page, min(entity_id) AS last_id, sum(CAST(wanted AS INT)) AS n FROM r GROUP BY ALL),
u AS (SELECT *, sum(n) OVER (PARTITION BY kind ORDER BY page) AS so_far FROM w),
e AS (SELECT kind, coalesce(max(last_id) FILTER (so_far >= 7), -1) AS cursor FROM u GROUP BY kind)
SELECT kind, entity_id, CAST(cursor AS BIGINT) AS cursor FROM r JOIN e USING (kind) WHERE wanted AND entity_id >= cursor""")
def crawl_feed_pages(spark, sf_dir):
    live, entries = _crawl(spark, sf_dir)
    cursors = live.filter("kind = 'supplier'").select("kind", F.lit(9).alias("cursor")).distinct()
    return workqueue.crawl_pages(entries, live, "2024-01-01", 5, 10, 7, cursors)


@query(f"WITH {QUEUE_SQL} SELECT kind, entity_id, 3 AS priority FROM q WHERE next_due_at >= TIMESTAMP '1998-01-01' AND (last_refreshed_at IS NULL OR last_refreshed_at < TIMESTAMP '1997-06-01')")
def queue_active(spark, sf_dir):
    q = queue(spark, sf_dir)
    return workqueue.queue_active(q, q.filter("next_due_at >= TIMESTAMP_NTZ '1998-01-01'"), "1997-06-01", 3, NOW).select("kind", "entity_id", "priority")
