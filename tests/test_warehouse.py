"""Operators on literal cases: guards, drift, precedence, upserts, the queue, checks, rates, sinks and the feed."""

import datetime as dt
import io
import itertools
import random
import tarfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.functions import scalars
from daymill.operators import changes, checks, entities, merge, nested, progress, rows, sinks, workqueue
from daymill.plans import named
from daymill.sources import archives, files, listings
from daymill.streaming import feed


def first(df):
    return df.first()[0]


def test_lenient_scalars(spark):
    df = spark.createDataFrame([("2003-03-12 20:04:00+00", 'W/"abc"', "Wed, 21 Oct 2015 07:28:00 GMT", "lake/2024/day=2024-01-02/x")], "t string, tag string, http string, path string")
    r = df.select(F.date_format(scalars.lenient_timestamp(F.col("t")), "HH:mm"), scalars.bare_tag(F.col("tag")), F.date_format(scalars.http_timestamp(F.col("http")), "yyyy-MM-dd HH:mm"), scalars.partition_day("day", F.col("path"))).first()
    assert tuple(r) == ("20:04", "abc", "2015-10-21 07:28", dt.date(2024, 1, 2))
    odd = spark.createDataFrame([("soon", '""')], "t string, tag string")
    assert tuple(odd.select(scalars.lenient_timestamp(F.col("t")), scalars.bare_tag(F.col("tag"))).first()) == (None, None)


def tar(members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:bz2") as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


def test_archives(spark, tmp_path):
    path = tmp_path / "day.tar.bz2"
    path.write_bytes(tar([("a.json", b' {"x": 1} '), ("b.json", b"{\n\"x\": 2\n}"), ("c.json", b"  "), ("note.txt", b"hi")]))
    docs = sorted(r.doc for r in archives.read_tar_json(spark, str(path)).collect())
    assert docs == ['{"x": 1}', '{"x": 2}']
    lines = archives.read_tar_members(spark, [str(path)], ["note.txt"]).collect()
    assert [r.line for r in archives.read_tar_members(spark, [path.as_uri()], ["note.txt"]).collect()] == [r.line for r in lines]
    assert [(r.member, r.line) for r in lines] == [("note.txt", "hi")]
    with pytest.raises(Exception, match="lacks"):
        archives.read_tar_members(spark, [str(path)], ["none.txt"]).collect()
    path.write_bytes(tar([("x/note.txt", b"a"), ("y/note.txt", b"b")]))
    with pytest.raises(Exception, match="more than once"):
        archives.read_tar_members(spark, [str(path)], ["note.txt"]).collect()


TYPES = {"date": "date", "region_id": "bigint", "lowest": "double", "highest": "double", "extra": "string"}


def test_csv_binds_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,region_id,lowest,highest\n2020-06-17,1,2,3\n")
    (tmp_path / "b.csv").write_text("highest,date,lowest,region_id,extra\n30,2020-06-18,20,10,x\n")
    got = files.read_daily_csv(spark, str(tmp_path), TYPES, ["extra"]).orderBy("region_id").collect()
    assert [tuple(r) for r in got] == [(dt.date(2020, 6, 17), 1, 2.0, 3.0, None), (dt.date(2020, 6, 18), 10, 20.0, 30.0, "x")]
    for bad in ("date,region_id,price\n", "date,date,region_id,lowest,highest\n"):
        (tmp_path / "c.csv").write_text(bad)
        with pytest.raises(ValueError, match="unknown header"):
            files.read_daily_csv(spark, str(tmp_path), TYPES, ["extra"])


def test_documents_fail_fast(spark):
    df = spark.createDataFrame([('{"id": 1}',), ("{broken",)], "doc string")
    with pytest.raises(Exception):
        files.parse_documents(df, "struct<id:bigint>").collect()
    assert files.read_feed(df.withColumnRenamed("doc", "value"), "struct<sequence_id:bigint>").count() == 0


def test_listing_of_both_shapes(spark):
    df = spark.createDataFrame([('[{"name":"a","size":1},{"size":2},5]',), ('{"files":[{"name":"b","url":"u"}]}',)], "body string")
    assert sorted((r.name, r.url) for r in listings.parse_listing(df, base_url="h/").collect()) == [("a", "h/a"), ("b", "u")]
    assert first(spark.createDataFrame([("1,234",)], "s string").select(listings.listed_size(F.col("s")))) == 1234


def test_nesting_guards(spark):
    docs = spark.createDataFrame([(1, [("p", '[{"part":2}]')]), (2, None), (3, [])], "id int, lines array<struct<part:string,extra:string>>")
    assert nested.explode_ordinal(docs, "lines", ["id"], {"part": "part"}).collect()[0].ordinal == 1
    assert nested.flatten_header(docs, {"id": "id"}, {"n": "lines"}).collect() == [(1, 1), (2, None), (3, 0)]
    both = nested.explode_two_levels(docs, "lines", ["id"], {"part": "part"}, "extra", "array<struct<part:string>>").collect()
    assert sorted((r.parent_ordinal or 0, r.ordinal, r.part) for r in both) == [(0, 1, "p"), (1, 1, "2")]
    deep = spark.createDataFrame([(1, [("p", '[{"extra":[{}]}]')])], docs.schema)
    assert nested.assert_max_depth(docs, "lines", "extra").count() == 3
    with pytest.raises(Exception, match="third level"):
        nested.assert_max_depth(deep, "lines", "extra").collect()
    day = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 2),)], "d date")
    with pytest.raises(Exception, match="a row of"):
        nested.assert_single_day(day, "d", "2024-01-01").collect()
    with pytest.raises(ValueError):
        nested.assert_same_count(3, 4)
    drift = nested.unknown_keys(spark.createDataFrame([('{"a":1,"b":{}}',), ("{}",)], "j string"), {"top": F.array("j")}, {"top": ["a"]})
    assert [tuple(r) for r in drift.collect()] == [("top", "b", 1)]


def test_bodies(spark):
    df = spark.createDataFrame([("[3,1,3,-2,0]",)], "b string")
    assert first(df.select(rows.json_body_ids(F.col("b")))) == [1, 3]
    with pytest.raises(Exception, match="no array"):
        spark.createDataFrame([("{}",)], "b string").select(rows.json_body_ids(F.col("b"))).collect()


def sources(spark):
    d = lambda i: dt.date(2024, 1, i)
    data = [(1, d(1), "a", d(1)), (1, d(1), "live", d(1)), (2, d(1), "live", d(2)), (2, d(1), "b", d(2)), (3, d(1), "b", d(4)), (4, None, "a", d(1)), (5, d(2), "live", d(1)), (1, d(2), "b", d(2))]
    return spark.createDataFrame(data, "id int, day date, source string, source_date date")


def test_precedence_and_spill(spark):
    got = {(r.id, r.day.day): (r.source, r.sources) for r in merge.merge_by_precedence(sources(spark), "id", "day", "source_date", ["a", "b", "live"]).collect()}
    assert got == {(1, 1): ("a", ["a", "live"]), (2, 1): ("b", ["b", "live"]), (5, 2): ("live", ["live"]), (1, 2): ("b", ["b"])}
    days = merge.affected_days(spark.createDataFrame([(dt.date(2024, 1, 1),)], "day date"))
    assert sorted(r.day.isoformat() for r in days.collect()) == ["2023-12-31", "2024-01-01", "2024-01-02"]
    assert merge.union_sources({"a": sources(spark).drop("source"), "b": None}, ["b", "a"]).select("rank").distinct().collect() == [(1,)]


def test_upserts_in_any_order(spark):
    schema = "id int, name string, observed_at timestamp"
    t = lambda d: dt.datetime(2024, 1, d)
    base = spark.createDataFrame([(1, "stored", t(2)), (2, "stored", t(2)), (3, "stored", t(2))], schema)
    parts = [[(1, "older", t(1)), (2, "tie", t(2))], [(3, "newer", t(3)), (3, "newest", t(4))], [(4, "new", t(1)), (2, "tie", t(2))]]
    results = set()
    for order in itertools.permutations(parts):
        out = entities.seed_all(base, [spark.createDataFrame(p, schema) for p in order], ["id"])
        results.add(tuple(sorted((r.id, r.name) for r in out.collect())))
    assert results == {((1, "stored"), (2, "tie"), (3, "newest"), (4, "new"))}
    with pytest.raises(ValueError, match="missing"):
        entities.upsert_newer(base, base.drop("name"), ["id"], required=["name"])


def test_queue_is_fair(spark):
    now = dt.datetime(2024, 1, 1)
    q = [("a", i, 1, None if i % 2 else now, now, None, 0, None) for i in range(6)] + [("b", 9, 1, now, now, None, 0, None), ("c", 7, 0, now, now, None, 0, None), ("c", 8, 0, now, now + dt.timedelta(days=1), None, 0, None)]
    queue = spark.createDataFrame(q, "kind string, entity_id int, priority int, last_refreshed_at timestamp, next_due_at timestamp, etag string, failures int, last_error string")
    got = [(r.kind, r.entity_id) for r in workqueue.take(queue, now, 5).collect()]
    assert got == [("c", 7), ("a", 1), ("b", 9), ("a", 3), ("a", 5)]
    done = spark.createDataFrame([("a", 1, now, 200, None), ("b", 9, now, 503, "x"), ("c", 7, now, 404, "gone")], "kind string, entity_id int, at timestamp, status int, error string")
    after = {(r.kind, r.entity_id): r for r in workqueue.apply_outcomes(queue, done).collect()}
    assert after["a", 1].priority == workqueue.IDLE and after["a", 1].next_due_at == now + dt.timedelta(days=3650)
    assert after["b", 9].priority == 1 and after["b", 9].next_due_at == now + dt.timedelta(hours=1) and after["b", 9].failures == 1
    assert after["c", 7].last_error == "gone" and after["c", 7].next_due_at == now + dt.timedelta(days=365)


def test_stale_runs_start_anew(spark):
    df = spark.createDataFrame([("o", i, tag, "x") for i, tag in enumerate("yyzyyyxy")], "k string, n int, tag string, current string")
    got = [r.stale_runs for r in changes.stale_runs(df, ["k"], ["n"], "tag", "current").orderBy("n").collect()]
    assert got == [1, 2, 1, 1, 2, 3, 0, 1]


def test_hashes_of_zipped_files(spark, tmp_path):
    import gzip
    import hashlib

    (tmp_path / "a.gz").write_bytes(gzip.compress(b"raw"))
    (tmp_path / "b").write_bytes(b"raw")
    got = {r.raw_path.rsplit("/", 1)[1]: r for r in checks.file_hashes(spark, str(tmp_path)).collect()}
    want = hashlib.sha256(b"raw").hexdigest()
    assert got["a.gz"].unzipped_sha256 == want == got["b"].sha256 and got["b"].unzipped_sha256 is None


def test_verify_of_a_range(spark):
    o = spark.createDataFrame(
        [("d", "k1", dt.date(2024, 1, 1), "imported", 2, "e", 5, 5), ("d", "k2", dt.date(2024, 1, 2), "provisional", 1, "e", 9, 4), ("d", "k3", dt.date(2024, 1, 3), "imported", 7, "e", None, 1), ("d", "k4", dt.date(2024, 1, 4), "failed", None, "e", None, None)],
        "dataset string, object_key string, logical_date date, status string, current_revision int, etag string, expected_count long, observed_count long",
    )
    r = spark.createDataFrame([("d", "k1", 1, "s", "p1", "e", 5), ("d", "k1", 2, "s", "p2", "e", 3), ("d", "k2", 1, "s", "p3", "e", 4)], "dataset string, object_key string, revision int, sha256 string, raw_path string, upstream_etag string, observed_count long")
    p = spark.createDataFrame([("t", dt.date(2024, 1, 1), 5, "d", "k1", 1, ["x"]), ("t", dt.date(2024, 1, 2), 4, "d", "k2", 1, []), ("t", dt.date(2023, 1, 1), 4, "d", "old", 1, [])], "table_name string, logical_date date, n_rows long, dataset string, object_key string, revision int, unknown_keys array<string>")
    there = spark.createDataFrame([("p2",)], "raw_path string")
    hashes = there.select("raw_path", F.lit("other").alias("sha256"), F.lit(None).cast("string").alias("unzipped_sha256"))
    found = lambda *days: sorted((x.object_key, x.kind) for x in checks.verify(o, r, p, there, hashes, {"d": ["t"]}, *days).collect())
    first_day = [("k1", "expected_count"), ("k1", "raw_hash"), ("k1", "row_count"), ("k1", "stale_partition"), ("k1", "unknown_keys")]
    rest = [("k2", "missing_raw"), ("k2", "provisional"), ("k3", "missing_revision"), ("k4", "failed_object")]
    assert found() == sorted([*first_day, *rest, ("old", "orphan_partition")])
    assert found("2024-01-01", "2024-01-01") == first_day
    assert found("2024-01-02") == rest
    assert tuple(checks.checked(o, hashes, "2024-01-02").first()) == (2, 1)


def test_manifest_without_drift(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)], "day date, id int")
    unknown = spark.createDataFrame([(dt.date(2024, 1, 2), ["a"])], "day date, unknown_keys array<string>")
    got = sinks.manifest_rows(df.groupBy("day").agg(F.count("*").alias("n_rows")), "t", "day", "d", 1, 3, unknown=unknown).orderBy("day").collect()
    assert [(r.n_rows, r.unknown_keys, r.sha256, r.built_from) for r in got] == [(1, [], None, None), (1, ["a"], None, None)]
    assert all(r.written_at for r in got)


def test_budget_is_used_up_beyond_a_page(spark):
    now = dt.datetime(2024, 1, 1)
    queue = spark.range(12_000).select(F.lit("a").alias("kind"), F.col("id").alias("entity_id"), F.lit(1).alias("priority"), F.lit(None).cast("timestamp").alias("last_refreshed_at"), F.lit(now).alias("next_due_at"))
    spent = workqueue.within_budget(queue, now, 11_000, {}).agg(F.count("*"), F.max("spent"), F.max("entity_id")).first()
    assert tuple(spent) == (11_000, 11_000, 10_999)
    assert workqueue.within_budget(queue, now, 11_001, {"a": 2}).count() == 5_500
    with pytest.raises(ValueError, match="below 1"):
        workqueue.within_budget(queue, now, 10, {"a": 0})


def test_rates_never_fall(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    df = spark.createDataFrame([("s", at(0), 10), ("s", at(1), 40), ("s", at(2), 5), ("s", at(2), 6)], "series string, at timestamp, value int")
    got = [(r.delta, r.per_minute) for r in progress.counter_rates(df, ["series"]).orderBy("at", "value").collect()]
    assert got[:3] == [(None, None), (30, 30.0), (0, 0.0)] and got[3][1] is None


SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("day", T.DateType())])


def test_days_are_replaced_and_emptied(spark, tmp_path):
    path, d = str(tmp_path / "t"), lambda i: dt.date(2024, 1, i)
    rows_ = spark.createDataFrame([(i, 1, d(i % 3 + 1)) for i in range(9)], SCHEMA)
    sinks.write_days(rows_, path, SCHEMA, "day", ["id"])
    sinks.write_days(rows_.filter("id = 4"), path, SCHEMA, "day", ["id"], [d(2), d(3)])
    got = files.read_table(spark, path, SCHEMA, "day")
    assert sorted((r.id, r.day.day) for r in got.collect()) == [(0, 1), (3, 1), (4, 2), (6, 1)]
    assert got.columns == ["id", "seq", "day"]
    plan = files.read_table(spark, path, SCHEMA, "day", "2024-01-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    with pytest.raises(ValueError, match="unknown column"):
        files.read_table(spark, path, SCHEMA, "day", columns=["nope"])
    assert files.read_table(spark, str(tmp_path / "none"), SCHEMA, "day").count() == 0
    with pytest.raises(ValueError, match="missing"):
        sinks.to_contract(rows_.drop("seq"), SCHEMA)


def test_flush_keeps_the_higher_sequence(spark, tmp_path):
    path, rnd = str(tmp_path / "live"), random.Random(1)
    batches = [[(rnd.randrange(20), s, dt.date(2024, 1, 1)) for s in range(k * 10, k * 10 + 10)] + [(None, 1, None)] for k in range(4)]
    for order in (batches, [batches[0], batches[1], batches[0], batches[1], batches[2], batches[3], batches[3]]):
        flush = feed.LiveFlush(path, SCHEMA, "id", "seq", "day")
        for i, b in enumerate(order):
            flush.process(spark.createDataFrame(b, SCHEMA), i)
        best = {}
        for i, s, _ in itertools.chain(*batches):
            if i is not None:
                best[i] = max(s, best.get(i, -1))
        assert {r.id: r.seq for r in files.read_table(spark, path, SCHEMA, "day").collect()} == best
    assert flush.skipped == len(order)


def test_gaps_across_ranges(spark):
    now = dt.datetime(2024, 1, 1)
    seqs = [1, 2, 5, 65535, 65537, 200000, 200001]
    df = spark.createDataFrame([(s, now) for s in seqs], "s long, t timestamp")
    got = {(r.after, r.before): r.missing for r in feed.sequence_gaps(df, "s", "t", dt.datetime(2024, 1, 2)).collect()}
    assert got == {(2, 5): 2, (5, 65535): 65529, (65535, 65537): 1, (65537, 200000): 134462}
    assert feed.sequence_gaps(df, "s", "t", now).count() == 0


def test_named_parameters(spark):
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string").createOrReplaceTempView("members")
    assert [r.name for r in named.run_named(spark, "members_by_id", {"ids": "2,2"}).collect()] == ["b"]
    for name, params in (("members_by_id", {}), ("members_by_id", {"ids": "1", "x": "2"}), ("members_by_id", {"ids": "one"}), ("none", {})):
        with pytest.raises(ValueError):
            named.run_named(spark, name, params)
    sinks.register_views(spark, {"void": (None, SCHEMA)})
    assert spark.table("void").columns == SCHEMA.names


def test_bounded_results(spark):
    df = spark.range(10)
    assert sinks.to_rows(df)["row_count"] == 10 and sum(b.num_rows for b in sinks.to_arrow(df, 3)) == 10
    with pytest.raises(ValueError):
        sinks.to_rows(df, 5)


QUEUE = "kind string, entity_id long, priority int, last_refreshed_at timestamp, next_due_at timestamp, etag string, failures int, last_error string"


def test_affiliation_by_literal_rows(spark):
    stored = spark.createDataFrame(
        [(1, 7, None, None, True), (2, 4, 40, "x", True), (3, 5, 50, "x", False), (4, 5, 50, "x", False), (5, 5, 50, "x", False), (6, 5, 50, "x", True), (7, 5, 50, "x", False), (8, 7, None, None, False)],
        "id long, group_id long, parent_id long, title string, deleted boolean",
    )
    results = spark.createDataFrame(
        [(1, True, 7, None, None), (2, True, 7, None, None), (3, True, 5, 51, "x"), (4, False, None, None, None), (5, True, 7, 70, "y"), (6, True, 5, 50, "x"), (7, True, 6, None, "x"), (8, True, 7, None, None), (9, True, 7, None, None), (10, False, None, None, None), (None, True, 1, 1, "x")],
        "id long, valid boolean, group_id long, parent_id long, title string",
    )
    found = entities.classify_affiliation(results, stored, "id", 7)
    assert {r.id: (r["class"], r.changed) for r in found.collect()} == {
        1: ("same", False), 2: ("moved_to_deleted", False), 3: ("attributes_only", False), 4: ("invalid", False), 5: ("moved_to_deleted", False),
        6: ("restored_or_moved", True), 7: ("restored_or_moved", True), 8: ("moved_to_deleted", False), 9: ("unknown", True), 10: ("same", False),
    }
    assert sorted(map(tuple, entities.affiliation_rows(found, stored, "id").collect())) == [
        (2, 7, None, None, True), (3, 5, 51, "x", False), (4, 5, 50, "x", True), (5, 7, None, None, True), (6, 5, 50, "x", False), (7, 6, None, "x", False), (8, 7, None, None, True),
    ]


def test_refusals_by_status(spark):
    now = dt.datetime(2024, 1, 1)
    queue = spark.createDataFrame([("a", s, 3, now, now, None, 1, "old") for s in (200, 400, 403, 404, 408, 410, 420, 429, 500)], QUEUE)
    done = queue.select("kind", "entity_id", F.lit(now).alias("at"), F.col("entity_id").alias("status"), F.lit("e" * 600).alias("error"))
    after = {r.entity_id: r for r in workqueue.apply_outcomes(queue, done).collect()}
    assert {s for s, r in after.items() if r.priority == workqueue.IDLE} == {200, 400, 404, 410}
    assert all(after[s] == (("a", s, 3, now, now, None, 1, "old")) for s in (403, 420))
    assert all(after[s].next_due_at == now + dt.timedelta(hours=2) and after[s].failures == 2 and len(after[s].last_error) == 500 for s in (408, 429, 500))


def test_groups_and_members_ask_the_queue(spark):
    queue = spark.createDataFrame([("g", 1, dt.datetime(2024, 3, 1)), ("g", 2, dt.datetime(2024, 1, 1)), ("g", 3, None), ("m", 4, dt.datetime(2024, 1, 1))], "kind string, entity_id long, last_refreshed_at timestamp")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id long")
    stored = spark.createDataFrame([(1, False), (2, True), (3, False), (4, False), (5, False), (6, True)], "id long, deleted boolean")
    got = entities.group_diff(ids(1, 2, 3, 4, 7), stored, "id", queue, "g", "2024-02-01")
    assert sorted(map(tuple, got.collect())) == [(2, "active"), (3, "active"), (4, "active"), (5, "closed"), (7, "new")]


def test_crawl_counts_its_own_class(spark):
    now, late = dt.datetime(2024, 1, 1), dt.datetime(2030, 1, 1)
    queue = spark.createDataFrame([("a", i, 1, None, now, None, 0, None) for i in range(50)] + [("a", 50, 5, None, late, None, 0, None)], QUEUE)
    ids = spark.createDataFrame([("a", i) for i in range(100)] + [("b", i) for i in range(3)], "kind string, entity_id long")
    assert workqueue.crawl_facts(queue, ids, now, 5, 1).count() == 52
    assert workqueue.crawl_facts(queue, ids, now, 1, 1).count() == 0
    page = lambda cursors: sorted(map(tuple, workqueue.crawl_pages(queue, ids, now, 5, 1, 7, cursors).collect()), key=str)
    assert page(None) == sorted([("a", i, 93) for i in range(93, 100)] + [("b", i, -1) for i in range(3)], key=str)
    after = spark.createDataFrame([("a", 55), ("b", -1)], "kind string, cursor long")
    assert page(after) == sorted([("a", i, -1) for i in range(51, 55)], key=str)
    assert page(spark.createDataFrame([("a", 40), ("b", -1)], "kind string, cursor long")) == [("a", None, -1)]


def test_history_alone_costs_one(spark):
    now = dt.datetime(2024, 1, 1)
    queue = spark.createDataFrame([("a", i, 5, None, now, None, 0, None) for i in range(10)], QUEUE)
    stored = spark.createDataFrame([("a", i) for i in range(5)], "kind string, entity_id long")
    assert workqueue.within_budget(queue, now, 9, {"a": 2}, stored, light=(5,)).count() == 7
    assert workqueue.within_budget(queue, now, 9, {"a": 2}).count() == 4


def plain_tar(path, members):
    with tarfile.open(path, "w") as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))


def test_members_of_one_archive_come_from_several_tasks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    docs = [(f"d/{i}.json", b' {"x": %d}\n' % i if i % 9 else b"{\n\"x\": %d}" % i) for i in range(200)]
    plain_tar(tmp_path / "in/a.tar", [*docs, ("d/empty.json", b" \n"), ("d/note.txt", b"no")])
    (tmp_path / "in/b.tar.bz2").write_bytes(tar([("z.json", b'{"x": 999}')]))
    df = archives.read_tar_documents(spark, str(tmp_path / "in"), chunk=20_000)
    got = df.select("doc", F.spark_partition_id().alias("task")).collect()
    assert sorted(int(r.doc[6:-1]) for r in got) == [*range(200), 999] and len({r.task for r in got}) > 4
    index = archives.tar_index(spark, str(tmp_path / "in")).collect()
    assert len(index) == 203 and [r.member for r in index if r.path.endswith("bz2")] == [None]


@pytest.mark.parametrize("chunk", [7, 64, 1000, 1 << 20])
def test_lines_of_one_member_come_from_several_tasks(spark, tmp_path, chunk):
    rnd = random.Random(chunk)
    texts = {n: ["é" * rnd.randrange(30) for _ in range(60)] for n in ("one.txt", "two.txt")}
    data = {n: "\n".join(t).encode() + (b"\n" if n == "one.txt" else b"") for n, t in texts.items()}
    plain_tar(tmp_path / "a.tar", [("x/one.txt", data["one.txt"]), ("x/other.txt", b"?"), ("two.txt", data["two.txt"]), ("none.txt", b"")])
    (tmp_path / "b.tar.bz2").write_bytes(tar([(n, d) for n, d in data.items()]))
    read = lambda name, names: sorted((r.member, r.line) for r in archives.read_tar_lines(spark, str(tmp_path / name), names, chunk).collect())
    want = sorted((r.member, r.line) for r in archives.read_tar_members(spark, [str(tmp_path / "a.tar")], list(texts)).collect())
    assert read("a.tar", list(texts)) == want and len(want) >= 119
    assert read("b.tar.bz2", list(texts)) == want
    assert read("a.tar", ["none.txt"]) == []
    with pytest.raises(ValueError, match="lacks three"):
        read("a.tar", ["two.txt", "three.txt"])
    plain_tar(tmp_path / "c.tar", [("x/two.txt", b"1"), ("y/two.txt", b"2")])
    with pytest.raises(ValueError, match="more than once"):
        read("c.tar", ["two.txt"])


def test_hashes_are_streamed(spark, tmp_path):
    import gzip
    import hashlib

    data = bytes(random.Random(1).randrange(256) for _ in range(5000)) + b"0" * 300_000
    zipped = gzip.compress(data[:2000]) + gzip.compress(data[2000:])
    for name, content in (("a 100%.gz", zipped), ("b.gz", zipped[:-20]), ("c.gz", b"no gzip at all"), ("d", data)):
        (tmp_path / name).write_bytes(content)
    got = {r.raw_path.rsplit("/", 1)[1]: r for r in checks.file_hashes(spark, str(tmp_path), piece=777).collect()}
    want = hashlib.sha256(data).hexdigest()
    assert got["a 100%.gz"].unzipped_sha256 == want == got["d"].sha256 and got["a 100%.gz"].sha256 == hashlib.sha256(zipped).hexdigest()
    assert got["b.gz"].unzipped_sha256 != want and got["c.gz"].unzipped_sha256 is None


def test_statistics_come_from_footers(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("day", T.DateType())])
    df = spark.range(1000).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("day"))
    sinks.write_days(df, f"{tmp_path}/t", schema, "day", ["id"], files=2)
    stats = sinks.partition_stats(spark, f"{tmp_path}/t", "day")
    assert "parquet" not in stats._jdf.queryExecution().executedPlan().toString().lower().replace("*.parquet", "")
    n_files = {d: len([*(tmp_path / f"t/day=2024-01-0{d}").glob("*.parquet")]) for d in (1, 2, 3)}
    assert sorted((r.day.day, r.n_files, r.n_rows) for r in stats.collect()) == [(1, n_files[1], 334), (2, n_files[2], 333), (3, n_files[3], 333)]
    for part in (tmp_path / "t").glob("day=*/*.parquet"):  # data pages are not looked at
        raw = bytearray(part.read_bytes())
        footer = int.from_bytes(raw[-8:-4], "little") + 8
        raw[4 : len(raw) - footer] = bytes(len(raw) - footer - 4)
        part.write_bytes(raw)
    assert stats.agg(F.sum("n_rows")).first()[0] == 1000


def test_a_lost_row_stops_the_day(spark, tmp_path):
    docs = spark.createDataFrame([('{"id":1}',), ('{"id":2}',), ('{"id":null}',)], "doc string")
    parse = lambda df: files.parse_documents(df, "struct<id:bigint>").select("doc.id")
    staged, n = sinks.stage_counted(docs, parse, f"{tmp_path}/a")
    assert n == 3 and staged.count() == 3
    with pytest.raises(ValueError, match="2 rows from 3 documents"):
        sinks.stage_counted(docs, lambda df: parse(df).filter("id IS NOT NULL"), f"{tmp_path}/b")


def test_headers_are_read_and_no_more(spark, tmp_path):
    import bz2
    import gzip

    body = "a,b,c\n" + "".join(f"{i},{i * 7919 % 1000},{i * 104729 % 1000}\n" for i in range(200_000))
    (tmp_path / "plain.csv").write_text(body)
    (tmp_path / "one.csv.bz2").write_bytes(bz2.compress(body.encode()))
    (tmp_path / "two.csv.gz").write_bytes(gzip.compress(body.encode()))
    (tmp_path / "long.csv").write_text(",".join(f"column{i}" for i in range(2000)))
    got = {r.path.rsplit("/", 1)[1]: r for r in files.headers(spark, str(tmp_path)).collect()}
    assert all(got[n].header == "a,b,c" and got[n].n_read <= 4096 for n in ("plain.csv", "one.csv.bz2", "two.csv.gz"))
    assert len(got["long.csv"].header.split(",")) == 2000


def test_maps_join_their_days_index(spark, tmp_path):
    for name, text in (("docs/docs-2024-01-01.json", '{"1": {"x": 1}, "2": {"x": 2}, "n": 5}'), ("docs/docs-2024-01-02.json", '{"1": {"x": 3}}'), ("index/20240101.json", '{"1": "h1", "2": "h2"}'), ("index/20240103.json", '{"1": "h3"}')):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    got = sorted((r.id, r.doc, r.hash or "") for r in files.read_json_map(spark, f"{tmp_path}/docs", f"{tmp_path}/index").collect())
    assert got == [("1", '{"x":1}', "h1"), ("1", '{"x":3}', ""), ("2", '{"x":2}', "h2")]
    for bad in ("[1]", "5", '{"1": '):
        (tmp_path / "docs/bad-2024-01-05.json").write_text(bad)
        with pytest.raises(Exception):
            files.read_json_map(spark, f"{tmp_path}/docs").collect()


def test_third_level_fails_in_the_parse(spark):
    doc = "struct<id:bigint,lines:array<struct<part:bigint,extra:string>>>"
    make = lambda extra: files.parse_documents(spark.createDataFrame([('{"id":1,"lines":[{"part":1,"extra":%s},{"part":2}]}' % extra,)], "doc string"), doc)
    run = lambda extra: [tuple(r) for r in nested.explode_two_levels(make(extra), "doc.lines", ["doc.id"], {"part": "part"}, "extra", "array<struct<part:bigint,extra:string>>").collect()]
    assert run('[{"part":5,"extra":[]},{"part":6}]') == [(1, None, 1, 1), (1, 1, 1, 5), (1, 1, 2, 6), (1, None, 2, 2)]
    with pytest.raises(Exception, match="third level"):
        run('[{"part":5,"extra":[{"part":7}]}]')


def test_parents_of_refused_and_closed_results(spark):
    stored = spark.createDataFrame([(1, 5, 50, "x", False), (2, 7, None, None, True), (3, 5, 50, "x", False)], "id long, group_id long, parent_id long, title string, deleted boolean")
    results = spark.createDataFrame([(1, False, 5, 60, "x"), (2, True, 7, 61, None), (3, True, 7, 62, None), (4, True, 7, 63, None), (1, True, 6, 64, None), (9, True, 6, 50, None)], "id long, valid boolean, group_id long, parent_id long, title string")
    classified = entities.classify_affiliation(results, stored, "id", 7)
    known = spark.createDataFrame([(50,)], "parent_id long")
    assert sorted(r[0] for r in entities.unknown_parents(classified, known, closed_group=7).collect()) == [63, 64]


def test_a_merged_day_follows_its_sources(spark, tmp_path):
    from daymill.operators.layers import Layers

    fact = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("day", T.DateType())])
    part = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("day", T.DateType())])
    of = Layers(str(tmp_path), ["a", "live"], "id", fact, {"parts": (part, ["id", "n"])})
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]

    def put(source, table, schema, rows, over=None):
        sinks.write_days(spark.createDataFrame(rows, schema), of.source_path(source, table), schema, "day", ["id"], over)

    put("a", "objects", fact, [(1, "a1", days[0]), (2, "a2", days[1])])
    put("a", "parts", part, [(1, 10, days[0]), (1, 11, days[0]), (2, 20, days[1])])
    put("live", "objects", fact, [(1, "l1", days[0]), (3, "l3", days[0])])
    put("live", "parts", part, [(1, 90, days[0]), (3, 91, days[0])])
    of.rebuild(spark, days)
    read = lambda t, *c: sorted(tuple(r) for r in of.read_merged(spark, t).select(*c).collect())
    assert read("objects", "id", "v", "source") == [(1, "a1", "a"), (2, "a2", "a"), (3, "l3", "live")]
    assert read("parts", "id", "n") == [(1, 10), (1, 11), (2, 20), (3, 91)]
    put("a", "objects", fact, [], days[:1])
    put("a", "parts", part, [], days[:1])
    of.rebuild(spark, days[:1])
    assert read("objects", "id", "v", "source") == [(1, "l1", "live"), (2, "a2", "a"), (3, "l3", "live")]
    assert read("parts", "id", "n") == [(1, 90), (2, 20), (3, 91)]
