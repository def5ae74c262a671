"""What a task holds or writes doesn't grow with the table."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymill.operators import layers, sinks
from daymill.sources import stores
from daymill.streaming import feed


def test_files_are_written_from_small_batches(spark, tmp_path, monkeypatch):
    """All the files of a task came as one batch of up to 64 MB."""
    df = spark.range(48, numPartitions=1).select(F.col("id").cast("string").alias("name"), F.encode(F.repeat(F.lit("x"), 1 << 20), "utf-8").alias("content"))
    most, written = [], stores._written

    def spied(*a):
        most.append(written(*a).agg(F.max("n")).first()[0])
        return written(*a)

    monkeypatch.setattr(stores, "_written", spied)
    before = spark.conf.get(stores.BATCH[0], None)
    assert stores.write_files(df, str(tmp_path)) == 48
    assert most[0] <= 10 and spark.conf.get(stores.BATCH[0], None) == before
    assert {p.stat().st_size for p in tmp_path.iterdir() if p.name.isdigit()} == {1 << 20}


def test_large_days_are_split_over_files(spark, tmp_path, monkeypatch, request):
    """A day of the live table, its children and the merged layer was one file, so one task."""
    monkeypatch.setattr(sinks, "ROWS", 10)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else small files are put together
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    day = dt.date(2024, 1, 1)
    fact = T.StructType([T.StructField("id", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("day", T.DateType())])
    part = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("day", T.DateType())])
    of = layers.Layers(str(tmp_path), ["live"], "id", fact, {"parts": (part, ["id", "n"])})
    child = feed.Child(of.source_path("live", "parts"), part, ["id", "n"], lambda o: o.select("id", F.explode(F.array(F.col("seq"), F.col("seq") + 1)).alias("n"), "day"))
    flush = feed.LiveFlush(of.source_path("live", "objects"), fact, "id", "seq", "day", children=[child], after=lambda s, days: of.rebuild(s, [r[0] for r in days.collect()]))
    for i, (rows, shift) in enumerate([(range(40), 100), (range(30, 60), 200), (range(30, 60), 200)]):
        flush.process(spark.createDataFrame([(k, k + shift, day) for k in rows], fact), i)
    want = {k: k + (200 if k >= 30 else 100) for k in range(60)}
    for path in (of.source_path("live", "objects"), of.source_path("live", "parts"), of.merged_path("objects"), of.merged_path("parts")):
        assert len([*(tmp_path / path / f"day={day}").glob("*.parquet")]) > 2
    assert {r.id: r.seq for r in of.read_merged(spark, "objects").collect()} == want and of.read_merged(spark, "objects").count() == 60
    assert sorted((r.id, r.n) for r in of.read_merged(spark, "parts").collect()) == sorted((k, s + i) for k, s in want.items() for i in (0, 1))
