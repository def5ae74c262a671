"""Bucketed children, entities by bucket and bitmaps of ids."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.operators import buckets, merge


def test_children_are_joined_where_they_lie(spark, tmp_path):
    rows = [(i, s, dt.date(2024, 1, 1 + i % 5), i * k) for i in range(200) for s in ("a", "b") for k in (1, 2)]
    children = spark.createDataFrame(rows, "id long, source string, source_date date, amount long")
    name = f"children_{uuid.uuid4().hex}"
    keys = ["id", "source", "source_date"]
    kept = buckets.save_bucketed(children, name, f"{tmp_path}/c", keys, 16)
    try:
        chosen = spark.createDataFrame([(i, "ab"[i % 2], dt.date(2024, 1, 1 + i % 5), dt.date(2024, 1, 1 + i % 5)) for i in range(0, 200, 3)], "id long, source string, source_date date, day date")
        joined = merge.children_of_chosen(kept, chosen.hint("merge"), "id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and plan.count(" Exchange ") == 1  # the parents' alone
        want = merge.children_of_chosen(children, chosen, "id")
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want.collect())) and want.count() == 134
    finally:
        spark.sql(f"DROP TABLE {name}")


ENTITY = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType()), T.StructField("observed_at", T.TimestampType())])


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    t = lambda d: dt.datetime(2024, 1, d)
    entities = buckets.EntityBuckets(f"{tmp_path}/e", ENTITY, ["id"], 8)
    entities.upsert(spark.createDataFrame([(i, "old", t(2)) for i in range(200)], ENTITY))
    files = lambda: {p.parent.name: p.name for p in (tmp_path / "e").glob("bucket=*/*.parquet")}
    before = files()
    assert len(before) == 8
    touched = entities.upsert(spark.createDataFrame([(5, "newer", t(3)), (5, "newest", t(4)), (1000, "new", t(1)), (5, "older", t(1))], ENTITY))
    after = files()
    assert 1 <= len(touched) <= 2 and {b for b in after if after[b] != before[b]} == {f"bucket={b}" for b in touched}
    got = {r.id: r.v for r in entities.read(spark).collect()}
    assert len(got) == 201 and got[5] == "newest" and got[1000] == "new" and got[6] == "old"
    assert entities.upsert(spark.createDataFrame([(5, "late", t(2))], ENTITY)) and entities.read(spark).filter("id = 5").first().v == "newest"
    assert entities.upsert(spark.createDataFrame([], ENTITY)) == []


@pytest.mark.parametrize("seed", [1, 2])
def test_bitmaps_count_exactly(spark, tmp_path, seed):
    rnd = random.Random(seed)
    days = [dt.date(2024, 1, d) for d in range(1, 6)]
    make = lambda n: [(rnd.choice(days), rnd.choice([None, 0, -5, 1, 32768, 32769, 65536, rnd.randrange(1, 10**6)]), rnd.randrange(1, 50)) for _ in range(n)]
    rows = make(400)
    df = lambda r: spark.createDataFrame(r, "d date, a long, b int")
    path = f"{tmp_path}/b"
    buckets.write_bitmaps(df(rows), path, "d", {"a": "x", "b": "y"})
    again = [r for r in make(100) if r[0] == days[1]]
    rows = [r for r in rows if r[0] not in (days[1], days[2])] + again  # one day changed, one emptied
    buckets.write_bitmaps(df(again), path, "d", {"a": "x", "b": "y"}, days[1:3])
    stored = spark.read.schema(buckets.BITMAPS).parquet(path)
    for low, high in ((0, 5), (1, 3), (3, 4)):
        own = [r for r in rows if r[0] in days[low:high]]
        got = {r.kind: (r.n_ids, r.n_rows) for r in buckets.distinct_ids(stored.filter(F.col("day").isin(days[low:high]))).collect()}
        want = {k: (len({r[i] for r in own if r[i] and r[i] > 0}), sum(1 for r in own if r[i] and r[i] > 0)) for k, i in (("x", 1), ("y", 2))}
        assert got == {k: v for k, v in want.items() if v[1]}
    by_day = {(r.day, r.kind): r.n_rows - r.n_ids for r in buckets.distinct_ids_by_day(stored).collect()}
    assert by_day[days[0], "y"] == sum(1 for r in rows if r[0] == days[0]) - len({r[2] for r in rows if r[0] == days[0]})
