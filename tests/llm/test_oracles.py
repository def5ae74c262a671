"""The corpus operators' SQL against their queries on the smallest tables."""

import os

import duckdb
import pytest

from daymill.llm import entry


@pytest.mark.parametrize("name", sorted(n for n, sql in entry.ORACLES.items() if sql))
def test_query_equals_sql(spark, sf_dir, name):
    c = duckdb.connect()
    for t in ("pages", "embeddings", "documents"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    want = c.execute(entry.ORACLES[name])
    columns = sorted(x[0] for x in want.description)
    rows = [dict(zip([x[0] for x in want.description], r)) for r in want.fetchall()]
    got = entry.QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == columns and rows
    assert sorted((tuple(r[c] for c in columns) for r in got.collect()), key=str) == sorted((tuple(r[c] for c in columns) for r in rows), key=str)
