"""Arrays read block by block against Python's own parser."""

import json
import random

import pyarrow as pa
import pytest

from daymill.sources import json_arrays

SCHEMA = "id bigint, text string, inner array<struct<x:bigint,t:string>>"


def records(n, seed=0):
    rnd = random.Random(seed)
    odd = ["}", "{", "]", "[", '"', "\\", "\\\"", "},{", "\n", "é", "漢", "😀", "\\\\", "{\"x\":1}", "plain", " ", "\\u007d"]
    word = lambda: "".join(rnd.choice(odd) for _ in range(rnd.randrange(12)))
    return [{"id": i, "text": word() * (400 if i % 97 == 5 else 1), "inner": [{"x": k, "t": word()} for k in range(rnd.randrange(4))]} for i in range(n)]


@pytest.fixture
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def as_rows(df):
    return sorted(((r.id, r.text, [(x.x, x.t) for x in r.inner]) for r in df.collect()))


@pytest.mark.parametrize("layout", [{}, {"indent": 3}, {"separators": (",", ":")}, {"ensure_ascii": False, "indent": "\t"}])
def test_blocks_cut_anywhere(spark, tmp_path, small_blocks, layout):
    data = records(300, len(str(layout)))
    half = 290
    (tmp_path / "a.json").write_text(json.dumps(data[:half], **layout), encoding="utf-8")
    (tmp_path / "b.json").write_text(" \n" + json.dumps(data[half:], **layout) + "\n\n", encoding="utf-8")
    (tmp_path / "none.json").write_text("[ ]")
    want = sorted((r["id"], r["text"], [(x["x"], x["t"]) for x in r["inner"]]) for r in data)
    df = json_arrays.read_json_array(spark, str(tmp_path), SCHEMA)
    assert as_rows(df) == want
    assert len(json_arrays.block_states(spark, str(tmp_path))) > 20 and df.rdd.getNumPartitions() > 20


def test_one_block_and_empty_files(spark, tmp_path):
    data = records(20)
    (tmp_path / "a.json").write_text(json.dumps(data))
    (tmp_path / "b.json").write_text("")
    assert len(as_rows(json_arrays.read_json_array(spark, str(tmp_path), SCHEMA))) == 20


@pytest.mark.parametrize("text", ['[{"id": 1}, 5]', '[{"id": 1}', '{"id": 1}]', '[{"id": 1}]]', '[{"id": "x}]', '[{"id": 1}, "a"]', '[{"id": 1}{"id": {}}', "[1, 2]"])
def test_what_is_no_array_of_records_fails(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception):
        json_arrays.read_json_array(spark, str(tmp_path), SCHEMA).collect()


def test_states_in_one_job_and_only_where_needed(spark, tmp_path):
    """The scan for states was a job for each task, and the states of all files went out to every task."""
    data = records(400)
    json_arrays.write_arrays(spark.createDataFrame([(json.dumps(r, indent=2),) for r in data], "value string"), str(tmp_path / "in"), 40)
    assert len([*(tmp_path / "in").glob("part-*")]) == 40
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000b")
    spark.sparkContext.setJobGroup("states", "states")
    try:
        assert len(json_arrays.block_states(spark, str(tmp_path / "in"))) >= 40
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("states")) <= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert as_rows(json_arrays.read_json_array(spark, str(tmp_path / "in"), SCHEMA)) == sorted((r["id"], r["text"], [(x["x"], x["t"]) for x in r["inner"]]) for r in data)


def test_arrays_are_written_by_several_tasks(spark, tmp_path):
    texts = [json.dumps({"id": i, "t": '}"],['}) for i in range(57)]
    json_arrays.write_arrays(spark.createDataFrame([(t,) for t in texts], "value string"), str(tmp_path / "in"), 5)
    parts = [json.loads(p.read_text()) for p in (tmp_path / "in").glob("part-*")]
    assert len(parts) == 5 and sorted(r["id"] for p in parts for r in p) == [*range(57)]
    json_arrays.write_arrays(spark.createDataFrame([], "value string"), str(tmp_path / "none"), 2)
    assert all(json.loads(p.read_text()) == [] for p in (tmp_path / "none").glob("part-*"))


def test_runs_of_fragments_are_bounded(monkeypatch):
    """A whole Arrow batch was one run, and its places took up to a gigabyte in a worker."""
    monkeypatch.setattr(json_arrays, "RUN", 50)
    batch = pa.RecordBatch.from_pydict({"path": ["f"] * 100, "start": [0] * 100, "value": [b'{"a": 1'] * 100})
    runs = [*json_arrays._blocks(iter([batch]))]
    assert max(len(text) for _, _, text, _ in runs) < 60 and [r[3] for r in runs] == [False] * (len(runs) - 1) + [True]
    assert b"".join(text for _, _, text, _ in runs) == b'{"a": 1}' * 99 + b'{"a": 1'
