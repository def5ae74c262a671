"""The feed source: planned ranges, restarts, replays."""

import json

import pytest

from daymill.sources import sequence_feed


def lines(sequences, **more):
    return [(json.dumps({"sequence_id": s, "x": s * 2} | more),) for s in sequences]


def run(spark, tmp_path, **options):
    df = sequence_feed.read_sequences(spark, f"{tmp_path}/feed", width=10, **options)
    df.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return sorted(r.sequence for r in spark.read.parquet(f"{tmp_path}/out").collect())


def test_restart_reads_each_sequence_once(spark, tmp_path):
    df = lambda rows: spark.createDataFrame(rows, "value string")
    odd = [("{broken",), ("",), (json.dumps({"sequence_id": "7"}),), (json.dumps({"sequence_id": True}),), (json.dumps([1]),), (json.dumps({"x": 1}),)]
    sequence_feed.land(df(lines(range(0, 27)) + lines(range(5, 9), again=1) + odd), f"{tmp_path}/feed", 10)
    assert run(spark, tmp_path) == [*range(27)]
    assert run(spark, tmp_path) == [*range(27)]
    sequence_feed.land(df(lines([27, 28, 31, 65]) + lines(range(20, 27))), f"{tmp_path}/feed", 10)
    assert run(spark, tmp_path) == [*range(29), 31, 65]
    sequence_feed.land(df(lines([66, 100])), f"{tmp_path}/feed", 10)
    assert run(spark, tmp_path) == [*range(29), 31, 65, 66, 100]


def test_nothing_landed_yet(spark, tmp_path):
    assert sequence_feed.SequenceReader({"path": f"{tmp_path}/none"}).latestOffset() == {"sequence": -1}


def test_ranges_are_planned(tmp_path, spark):
    sequence_feed.land(spark.createDataFrame(lines([*range(0, 30), 47]), "value string"), f"{tmp_path}/feed", 10)
    reader = sequence_feed.SequenceReader({"path": f"{tmp_path}/feed", "width": "10", "after": "3"})
    assert reader.initialOffset() == {"sequence": 3} and reader.latestOffset() == {"sequence": 47}
    parts = reader.partitions({"sequence": 9}, {"sequence": 47})
    assert [p.k for p in parts] == [1, 2, 4]
    assert [p.k for p in reader.partitions({"sequence": 29}, {"sequence": 40})] == [4]
    got = [s for p in reader.partitions({"sequence": 12}, {"sequence": 21}) for b in reader.read(p) for s in b.column(0).to_pylist()]
    assert sorted(got) == [*range(13, 22)]
    with pytest.raises(ValueError, match="stands in range"):
        [*sequence_feed.SequenceReader({"path": f"{tmp_path}/feed", "width": "7"}).read(parts[0])]
