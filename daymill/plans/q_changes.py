"""Change tracking and consistency checks over days of events as upstream objects."""

from __future__ import annotations

import gzip

from pyspark.sql import functions as F

from ..operators import changes, checks, merge
from ..scratch import folder
from ..sources import stores
from ._register import registry
from .inputs import MERGED_SQL, OBJECTS_SQL, ORDER_OF_SOURCES, SOURCES_SQL, objects, partitions, revisions, table, three_sources

query, QUERIES, ORACLES = registry()
W = f"WITH {OBJECTS_SQL}"


def _seen(spark, sf_dir):
    o = objects(spark, sf_dir).filter("d <> 10")
    return o.withColumn("etag", F.when(F.col("d") % 6 == 0, "new").otherwise(F.col("etag"))).withColumn("last_modified", F.col("last_modified") + F.expr("INTERVAL 1 MILLISECOND") * F.when(F.col("d") % 5 == 0, 300).otherwise(2))


@query(f"{W} SELECT dataset, object_key, CASE WHEN d = 12 THEN 'new' WHEN d % 6 = 0 OR status = 'gone' THEN 'changed' ELSE 'unchanged' END AS change FROM obj WHERE d <> 10")
def object_changes(spark, sf_dir):
    return changes.classify_objects(_seen(spark, sf_dir), objects(spark, sf_dir).filter("d <> 12"))


@query(f"{W} SELECT dataset, object_key FROM obj WHERE d = 10")
def objects_gone(spark, sf_dir):
    return changes.missing_objects(_seen(spark, sf_dir), objects(spark, sf_dir))


@query(f"{W} SELECT dataset, object_key FROM obj JOIN rev USING (dataset, object_key) WHERE status = 'imported' AND revision = current_revision AND parser_version < 2")
def parser_outdated(spark, sf_dir):
    return changes.parser_outdated(objects(spark, sf_dir), revisions(spark, sf_dir), 2)


@query(f"{W} SELECT dataset, object_key FROM obj WHERE status = 'imported' AND logical_date BETWEEN DATE '2024-01-02' AND DATE '2024-01-09'")
def forced(spark, sf_dir):
    return changes.force(objects(spark, sf_dir), "2024-01-02", "2024-01-09")


@query(f"{W} SELECT dataset, object_key, k, CAST(coalesce((SELECT max(revision) FROM rev WHERE rev.object_key = obj.object_key), 0) + k AS INT) AS revision FROM obj, (VALUES (1), (2)) t(k) WHERE d % 3 <> 1")
def next_revision(spark, sf_dir):
    new = objects(spark, sf_dir).filter("d % 3 <> 1").select("dataset", "object_key", F.explode(F.array(F.lit(1), F.lit(2))).alias("k"))
    return changes.add_revisions(new, revisions(spark, sf_dir), ["k"])


@query(f"""{W} SELECT dataset, object_key, revision, CASE WHEN imported_at IS NULL THEN 'pending' WHEN revision = max(CASE WHEN imported_at IS NOT NULL THEN revision END) OVER (PARTITION BY dataset, object_key) THEN 'imported' ELSE 'superseded' END AS state FROM rev""")
def current_revision(spark, sf_dir):
    return changes.current_revisions(revisions(spark, sf_dir)).select("dataset", "object_key", "revision", "state")


@query(f"{W} SELECT o.dataset, o.object_key, o.logical_date, o.current_revision FROM obj o JOIN rev r ON o.object_key = r.object_key AND r.revision = o.current_revision WHERE imported_at > TIMESTAMP '2024-01-20'")
def changed_since(spark, sf_dir):
    return changes.changed_since(objects(spark, sf_dir), revisions(spark, sf_dir), "2024-01-20").drop("imported_at")


@query(f"{W} SELECT dataset, object_key, status FROM obj WHERE dataset = 'events' AND status IN ('imported', 'provisional') AND logical_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-22'")
def list_objects(spark, sf_dir):
    return changes.list_objects(objects(spark, sf_dir), "events", ["imported", "provisional"], "2024-01-03", "2024-01-22").select("dataset", "object_key", "status")


@query(f"{W}, c AS (SELECT dataset, status, count(*) AS n FROM obj GROUP BY ALL) SELECT dataset, CAST(count(*) AS BIGINT) AS n_objects, (SELECT string_agg(status || '=' || n, ',' ORDER BY status) FROM c WHERE c.dataset = obj.dataset) AS by_status, min(logical_date) FILTER (status = 'imported') AS first_day, max(logical_date) FILTER (status = 'imported') AS last_day FROM obj GROUP BY dataset")
def dataset_summary(spark, sf_dir):
    return changes.dataset_summary(objects(spark, sf_dir))


@query(f"{W} SELECT r.object_key, r.revision, r.sha256 FROM rev r WHERE r.object_key = '2024/2024-01-08'")
def object_detail(spark, sf_dir):
    return changes.object_detail(objects(spark, sf_dir), revisions(spark, sf_dir), "events", "2024/2024-01-08").select("object_key", "revision", "sha256")


@query(f"""{W}, x AS (SELECT *, d = 12 OR logical_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-02' OR (status IN ('discovered', 'changed', 'fetched', 'failed', 'provisional') AND last_seen_at < TIMESTAMP '2024-01-10') OR status = 'provisional' OR d % 4 = 0 OR DATE '2024-02-01' - logical_date < 5 AS recheck FROM obj WHERE d <> 10)
SELECT dataset, object_key, recheck, CASE WHEN NOT recheck THEN etag WHEN d % 6 = 0 THEN 'new' ELSE etag END AS etag FROM x""")
def recheck_selection(spark, sf_dir):
    seen = _seen(spark, sf_dir).withColumn("listing_unchanged", F.col("d") % 4 != 0)
    return changes.select_recheck(seen.drop("last_seen_at"), objects(spark, sf_dir).filter("d <> 12"), "2024-02-01", 5, "2024-01-10", "2024-01-01", "2024-01-02").select("dataset", "object_key", "recheck", "etag")


@query(f"{W} SELECT object_key, CASE WHEN object_key LIKE '%01-29%' THEN 'old format' END AS reason FROM obj WHERE status IN ('discovered', 'changed', 'fetched', 'failed', 'provisional') ORDER BY logical_date DESC LIMIT 3")
def pending_objects(spark, sf_dir):
    return changes.pending_objects(objects(spark, sf_dir), {"01-29": "old format"}, 3).select("object_key", "reason")


@query(f"""{W}, k AS (SELECT dataset, object_key, upstream_etag, max(revision) AS kept FROM rev WHERE raw_path IS NOT NULL GROUP BY ALL)
SELECT o.dataset, o.object_key, CASE WHEN r.upstream_etag = o.etag AND r.parser_version = 2 THEN 'reuse' WHEN k.kept IS NOT NULL THEN 'replay' ELSE 'fetch' END AS action, CASE WHEN r.upstream_etag = o.etag AND r.parser_version = 2 THEN o.current_revision ELSE k.kept END AS revision
FROM obj o LEFT JOIN rev r ON o.object_key = r.object_key AND o.current_revision = r.revision LEFT JOIN k ON k.object_key = o.object_key AND k.upstream_etag = o.etag""")
def import_plan(spark, sf_dir):
    return changes.plan_import(objects(spark, sf_dir), revisions(spark, sf_dir), 2)


@query("""WITH a AS (SELECT user_id, event_id, ts, event_type, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
b AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM a),
c AS (SELECT *, CASE WHEN event_type = 'view' THEN 0 ELSE row_number() OVER (PARTITION BY user_id, island ORDER BY ts, event_id) END AS stale_runs FROM b)
SELECT event_id, CAST(stale_runs AS INT) AS stale_runs, stale_runs >= 3 AS provisional FROM c""")
def stale_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("current", F.lit("view"))
    return changes.stale_runs(e, ["user_id"], ["ts", "event_id"], "event_type", "current").select("event_id", "stale_runs", "provisional")


@query(f"{W} SELECT object_key, CASE WHEN expected_count IS NOT NULL THEN expected_count = observed_count END AS verified FROM obj")
def verified(spark, sf_dir):
    return objects(spark, sf_dir).select("object_key", changes.verified(F.col("expected_count"), F.col("observed_count")).alias("verified"))


@query(f"{W} SELECT object_key FROM obj WHERE object_key > '2024/2024-01-10' ORDER BY 1 LIMIT 7")
def sweep_slice(spark, sf_dir):
    return changes.sweep_slice(objects(spark, sf_dir), "2024/2024-01-10", 7)


@query("SELECT event_id AS run_id FROM events WHERE event_type = (SELECT min(event_type) FROM events) ORDER BY ts DESC, event_id DESC LIMIT 25")
def list_runs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    job = e.agg(F.min("event_type")).first()[0]
    return changes.list_runs(e.select(F.col("event_id").alias("run_id"), F.col("event_type").alias("job"), F.col("ts").alias("started_at"), F.col("ts").alias("finished_at")), job, 25).select("run_id")


# Checks


def _issue(kind: str, detail: str, source: str, severity: str = "issue", key: str = "object_key", dataset: str = "dataset") -> str:
    return f"SELECT {dataset} AS dataset, {key} AS object_key, '{kind}' AS kind, '{severity}' AS severity, {detail} AS detail FROM {source}"


TABLES = {"events": ["facts", "parts"], "market": ["facts", "parts"]}
FIRST = {"events": "facts", "market": "facts"}
O, R, P = objects, revisions, partitions


@query(f"{W} {_issue('failed_object', chr(39) + 'the last import failed' + chr(39), 'obj WHERE d = 3')}")
def check_failed_object(spark, sf_dir):
    return checks.check_failed_object(O(spark, sf_dir))


@query(f"{W} {_issue('missing_revision', chr(39) + 'revision ' + chr(39) + ' || current_revision', 'live WHERE d = 11')}")
def check_missing_revision(spark, sf_dir):
    return checks.check_missing_revision(O(spark, sf_dir), R(spark, sf_dir))


@query(f"{W} {_issue('missing_partition', 't || chr(32) || logical_date', '''live, (VALUES ('facts'), ('parts')) x(t) WHERE NOT EXISTS (SELECT 1 FROM part_ p WHERE p.table_name = t AND p.logical_date = live.logical_date)''')}")
def check_missing_partition(spark, sf_dir):
    return checks.check_missing_partition(O(spark, sf_dir), P(spark, sf_dir), TABLES)


@query(f"{W} {_issue('row_count', '''p.n_rows || ' rows, ' || r.observed_count || ' registered' ''', '''live l JOIN rev r ON l.object_key = r.object_key AND l.current_revision = r.revision JOIN part_ p ON p.table_name = 'facts' AND p.logical_date = l.logical_date WHERE p.n_rows <> r.observed_count''', key='l.object_key', dataset='l.dataset')}")
def check_row_count(spark, sf_dir):
    return checks.check_row_count(O(spark, sf_dir), R(spark, sf_dir), P(spark, sf_dir), FIRST)


@query(f"{W} {_issue('unknown_keys', 'unknown_keys', '''part_ WHERE unknown_keys <> '' ''')}")
def check_unknown_keys(spark, sf_dir):
    return checks.check_unknown_keys(P(spark, sf_dir))


@query(f"{W} {_issue('stale_partition', '''p.table_name || ' has ' || p.revision || ', current is ' || o.current_revision''', 'part_ p JOIN obj o USING (dataset, object_key) WHERE p.revision <> o.current_revision', key='o.object_key', dataset='o.dataset')}")
def check_stale_partition(spark, sf_dir):
    return checks.check_stale_partition(O(spark, sf_dir), P(spark, sf_dir))


@query(f"{W} {_issue('missing_raw', 'r.raw_path', 'live l JOIN rev r ON l.object_key = r.object_key AND l.current_revision = r.revision WHERE r.raw_path IS NOT NULL AND l.d % 9 = 0', key='l.object_key', dataset='l.dataset')}")
def check_missing_raw(spark, sf_dir):
    return checks.check_missing_raw(O(spark, sf_dir), R(spark, sf_dir), R(spark, sf_dir).filter("d % 9 <> 0").select("raw_path"))


@query(f"{W} {_issue('raw_hash', 'r.raw_path', 'live l JOIN rev r ON l.object_key = r.object_key AND l.current_revision = r.revision WHERE r.raw_path IS NOT NULL AND l.d % 8 = 1', key='l.object_key', dataset='l.dataset')}")
def check_raw_hash(spark, sf_dir):
    return checks.check_raw_hash(O(spark, sf_dir), R(spark, sf_dir), _hashes(spark, sf_dir))


def _hashes(spark, sf_dir):
    """Digests of raw files that were written: every eighth one damaged, another eighth zipped."""
    path = folder(spark, "raw")
    r = R(spark, sf_dir).filter("raw_path IS NOT NULL").select("raw_path", "d")

    def zipped(batches):
        for b in batches:
            yield b.assign(content=[gzip.compress(c.encode()) for c in b["raw_path"]])

    plain = r.filter("d % 8 <> 2").select(F.col("raw_path").alias("name"), F.concat("raw_path", F.when(F.col("d") % 8 == 1, "!").otherwise("")).cast("binary").alias("content"))
    packed = r.filter("d % 8 = 2").select("raw_path").mapInPandas(zipped, "raw_path string, content binary")
    stores.write_files(plain.unionByName(packed.select(F.concat("raw_path", F.lit(".gz")).alias("name"), "content")), path)
    return checks.file_hashes(spark, path).withColumn("raw_path", F.regexp_extract("raw_path", r"/(raw/\d+/.*?)(\.gz)?$", 1))


@query(f"{W} {_issue('provisional', chr(39) + 'an older copy is live' + chr(39), 'obj WHERE d = 4', 'note')}")
def check_provisional(spark, sf_dir):
    return checks.check_provisional(O(spark, sf_dir))


@query(f"""{W} SELECT l.dataset, l.object_key, CASE WHEN l.etag IS DISTINCT FROM r.upstream_etag THEN 'upstream_ahead' ELSE 'expected_count' END AS kind, CASE WHEN l.etag IS DISTINCT FROM r.upstream_etag THEN 'note' ELSE 'issue' END AS severity,
  'expected ' || expected_count || ', observed ' || r.observed_count AS detail FROM obj l JOIN rev r ON l.object_key = r.object_key AND l.current_revision = r.revision WHERE l.status = 'imported' AND expected_count <> r.observed_count""")
def check_expected_count(spark, sf_dir):
    return checks.check_expected_count(O(spark, sf_dir), R(spark, sf_dir))


@query(f"{W} {_issue('orphan_partition', '''table_name || ' ' || logical_date''', 'part_ p WHERE NOT EXISTS (SELECT 1 FROM live l WHERE l.dataset = p.dataset AND l.object_key = p.object_key)')}")
def check_orphan_partition(spark, sf_dir):
    return checks.check_orphan_partition(O(spark, sf_dir), P(spark, sf_dir))


@query("SELECT 'merged' AS dataset, CAST(CAST(ts AS DATE) AS VARCHAR) AS object_key, 'duplicate' AS kind, 'issue' AS severity, CAST(count(*) - count(DISTINCT user_id) AS VARCHAR) AS detail FROM events GROUP BY 2 HAVING count(*) > count(DISTINCT user_id)")
def check_duplicate(spark, sf_dir):
    return checks.check_duplicate(table(spark, sf_dir, "events"), "user_id", "ts", "merged")


@query(f"""WITH {SOURCES_SQL}, {MERGED_SQL}, m AS (SELECT day, count(DISTINCT event_id) AS m FROM merged WHERE event_id % 3 <> 1 GROUP BY 1), s AS (SELECT source, day, count(DISTINCT event_id) AS n FROM src GROUP BY ALL)
SELECT 'merged' AS dataset, CAST(day AS VARCHAR) AS object_key, 'merged_short' AS kind, 'issue' AS severity, source || ' ' || n || ' > ' || coalesce(m, 0) AS detail FROM s LEFT JOIN m USING (day) WHERE n > coalesce(m, 0)""")
def check_merged_short(spark, sf_dir):
    s = three_sources(spark, sf_dir)
    m = merge.merge_by_precedence(s, "event_id", "day", "source_date", ORDER_OF_SOURCES).filter("event_id % 3 <> 1")
    return checks.check_merged_short(s, m, "event_id", "day", "merged")


@query(f"""WITH {SOURCES_SQL}, h AS (SELECT DISTINCT source, source_date AS day FROM src WHERE source <> 'live' AND NOT (source = 'a' AND day(source_date) % 7 = 0))
SELECT 'merged' AS dataset, CAST(day AS VARCHAR) AS object_key, 'source_lacks_day' AS kind, 'note' AS severity, x.s AS detail FROM (SELECT DISTINCT day FROM h), (VALUES ('a'), ('b')) x(s) WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.day = day AND h.source = x.s AND h.day = object_key::DATE)""".replace("h.day = day AND h.source = x.s AND h.day = object_key::DATE", "h.source = x.s AND h.day = dd.day").replace("(SELECT DISTINCT day FROM h),", "(SELECT DISTINCT day FROM h) dd,"))
def check_source_lacks_day(spark, sf_dir):
    s = three_sources(spark, sf_dir).filter("NOT (source = 'a' AND day(source_date) % 7 = 0)")
    return checks.check_source_lacks_day(s, "source_date", ["a", "b"], "merged")


@query("SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT user_id) AS BIGINT) AS n_ids FROM events GROUP BY 1")
def day_counts(spark, sf_dir):
    return checks.day_counts(table(spark, sf_dir, "events"), "user_id", "ts")


REPORTED = ["failed_object", "missing_revision", "missing_partition", "row_count", "unknown_keys", "stale_partition", "missing_raw", "raw_hash", "provisional", "expected_count", "merged_short", "source_lacks_day"]
_ALL_DAYS = ORACLES["check_source_lacks_day"].replace(" AND NOT (source = 'a' AND day(source_date) % 7 = 0)", "")
_ISSUES = " UNION ALL ".join(f"SELECT * FROM ({_ALL_DAYS if k == 'source_lacks_day' else ORACLES['check_' + k]})" for k in REPORTED)


@query(f"SELECT kind, severity, CAST(count(*) AS BIGINT) AS n FROM ({_ISSUES}) WHERE right(object_key, 10) BETWEEN '2024-01-03' AND '2024-01-20' GROUP BY ALL")
def check_report(spark, sf_dir):
    days = ("2024-01-03", "2024-01-20")
    s = three_sources(spark, sf_dir)
    m = merge.merge_by_precedence(s, "event_id", "day", "source_date", ORDER_OF_SOURCES).filter("event_id % 3 <> 1")
    r = R(spark, sf_dir)
    of_datasets = checks.verify(O(spark, sf_dir), r, P(spark, sf_dir), r.filter("d % 9 <> 0").select("raw_path"), _hashes(spark, sf_dir), TABLES, *days)
    return checks.report([of_datasets, checks.verify_merged(s, m, "event_id", "day", "source_date", ["a", "b"], "merged", *days)])


@query(f"{W} SELECT CAST(count(*) AS BIGINT) AS n_objects, (SELECT CAST(count(*) AS BIGINT) FROM rev WHERE raw_path IS NOT NULL) AS n_hashed FROM live WHERE logical_date >= DATE '2024-01-10'")
def check_counts(spark, sf_dir):
    return checks.checked(O(spark, sf_dir), _hashes(spark, sf_dir).filter("raw_path IS NOT NULL"), "2024-01-10")


@query("SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n_rows FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-08' GROUP BY 1")
def rebuild(spark, sf_dir):
    """Kept raw documents of a range, read, parsed, flattened and written again as whole days."""
    from ..operators import nested, sinks
    from ..sources import files
    from .q_facts import EVENT_DAYS

    raw, out = folder(spark, "raw"), folder(spark, "rebuilt")
    e = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    e.select("day", F.to_json(F.struct("event_id", "user_id", "event_type")).alias("doc")).write.partitionBy("day").parquet(raw)
    docs = spark.read.schema("doc string, day date").parquet(raw).filter("day BETWEEN DATE '2024-01-05' AND DATE '2024-01-08'")
    parsed = files.parse_documents(docs, "struct<event_id:bigint,user_id:bigint,event_type:string>")
    flat = nested.flatten_header(parsed, {c: f"doc.{c}" for c in ("event_id", "user_id", "event_type")}, day="day")
    sinks.write_days(flat, out, EVENT_DAYS, "day", ["event_id"])
    return files.read_table(spark, out, EVENT_DAYS, "day").groupBy("day").agg(F.count("*").alias("n_rows"))
