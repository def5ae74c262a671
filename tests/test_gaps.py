"""Gaps of a stream against those of a batch, with replays and late objects."""

import datetime as dt
import itertools
import random

import numpy as np
import pytest

from daymill.streaming import feed, gaps

START = dt.datetime(2024, 1, 1)
SCHEMA = "s long, t timestamp, name string"


def land(spark, folder, i, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.json(f"{folder}/batch={i}")


def told_by(spark, tmp_path, batches, by_name=False):
    """What a stream tells after each batch, from one checkpoint."""
    out = []
    for i, rows in enumerate(batches):
        land(spark, tmp_path / "in", i, rows)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in/*")
        found = gaps.gap_stream(stream, "s", "t", feed="name" if by_name else None)
        gaps.start(found, f"{tmp_path}/out", f"{tmp_path}/checkpoint", every=None).awaitTermination()
        told = spark.read.schema(gaps.TOLD).parquet(f"{tmp_path}/out")
        out.append((sorted(tuple(r)[1:] for r in told.collect()), sorted(tuple(r) for r in gaps.open_gaps(told).collect())))
    return out


def at(s):
    return START + dt.timedelta(seconds=s)


def test_told_late_and_withdrawn(spark, tmp_path):
    rows = lambda *x: [(s, at(t), "f") for s, t in x]
    steps = told_by(
        spark, tmp_path,
        [
            rows((1, 0), (2, 1), (5, 10)),  # 3 and 4 are missing, but not for two minutes
            rows((6, 100), (4, 11)),  # 4 comes in time
            rows((9, 200), (10, 330)),  # now 3 is told, and 7-8 wait
            rows((10, 330), (5, 10)),  # replays
            rows((3, 12),),  # withdrawn
            rows((8, 210), (11, 600)),
        ],
    )
    told = [s[0] for s in steps]
    assert told[0] == told[1] == []
    assert told[2] == told[3] == [(2, 4, 1, False), (6, 9, 2, False)]
    assert told[4] == [(2, 4, 1, False), (2, 4, 1, True), (6, 9, 2, False)]
    assert steps[5][1] == [("", 6, 8, 1)]


@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_the_batch(spark, tmp_path, seed):
    rnd = random.Random(seed)
    objects = [(s, at(s * 3 + rnd.randrange(5)), rnd.choice("xy")) for s in range(400) if rnd.random() > 0.2]
    late = [o for o in objects if rnd.random() < 0.2]
    first = [o for o in objects if o not in late]
    batches = [first[i : i + 90] for i in range(0, len(first), 90)] + [late + first[:30], late[:10]]
    told = told_by(spark, tmp_path, batches, by_name=True)[-1][1]
    df = spark.createDataFrame(objects, SCHEMA)
    want = []
    now = max(t for _, t, _ in objects)
    for name in "xy":
        own = feed.sequence_gaps(df.filter(df.name == name), "s", "t", now)
        want += [(name, *r) for r in own.collect()]
    assert told == sorted(want) and want


def test_runs_join():
    rnd = np.random.default_rng(3)
    seen = {}
    state = (np.zeros(0, np.int64),) * 3
    for _ in range(30):
        s, t = rnd.integers(0, 200, 8), rnd.integers(0, 1000, 8)
        for a, b in zip(s.tolist(), t.tolist()):
            seen[a] = min(b, seen.get(a, b))
        state = gaps.joined(*(np.concatenate(x) for x in zip(state, gaps.runs(s, t))))
        groups = [[*g] for _, g in itertools.groupby(enumerate(sorted(seen)), lambda x: x[1] - x[0])]
        assert state[0].tolist() == [g[0][1] for g in groups] and state[1].tolist() == [g[-1][1] for g in groups]


def test_ranges_have_states_of_their_own(spark, tmp_path):
    """What a state holds is bounded by a range, also where gaps go over the ends of ranges and over empty ones."""
    rnd = random.Random(5)
    objects = [(s, at(s * 3 + rnd.randrange(5)), rnd.choice("xy")) for s in range(-60, 300) if rnd.random() > 0.3 and not 70 < s < 123]
    late = [o for o in objects if rnd.random() < 0.3]
    first = [o for o in objects if o not in late]
    for i, rows in enumerate([first[:150], first[150:], late + first[:30]]):
        land(spark, tmp_path / "in", i, rows)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in/*")
        gaps.start(gaps.gap_stream(stream, "s", "t", feed="name", width=8), f"{tmp_path}/out", f"{tmp_path}/checkpoint", every=None).awaitTermination()
    told = sorted(tuple(r) for r in gaps.open_gaps(spark.read.schema(gaps.TOLD).parquet(f"{tmp_path}/out")).collect())
    now, want = max(t for _, t, _ in objects), []
    for name in "xy":
        own = sorted((s, t) for s, t, n in objects if n == name)
        want += [(name, a, b, b - a - 1) for (a, _), (b, t) in itertools.pairwise(own) if b - a > 1 and t <= now - dt.timedelta(seconds=120)]
    assert told == sorted(want) and any(b - a > 16 for _, a, b, _ in want)
    state = spark.read.format("statestore").option("path", f"{tmp_path}/checkpoint").option("stateVarName", "runs").load()
    sizes = [len(r["value"]["first"]) for r in state.select("value").collect()]
    assert len(sizes) > 40 and sorted(sizes)[-3] <= 4


def test_ends_of_ranges():
    rnd = np.random.default_rng(4)
    s, t = rnd.integers(-90, 200, 60), rnd.integers(0, 1000, 60)
    first, last, at_ms = gaps.ends(*gaps.runs(s, t, 16), 16)
    of = {}
    for a, b in zip(s.tolist(), t.tolist()):
        of.setdefault(a // 16, []).append((a, b))
    assert [*zip(first.tolist(), last.tolist(), at_ms.tolist())] == [(min(of[r])[0], max(of[r])[0], min(of[r])[1]) for r in sorted(of)]
