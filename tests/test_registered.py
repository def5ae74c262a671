"""Registered queries against their SQL on the smallest tables, and their plans."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = {k: v for k, v in entry.queries().items() if not k.startswith("op") and k != "pipeline"}


@pytest.fixture(scope="module")
def tables(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return c


def text(v):
    if v is None or v is pd.NaT or v is pd.NA or v != v:
        return "null"
    if isinstance(v, float):
        return str(int(v)) if v == int(v) else repr(round(v, 6))
    return str(v).replace(" 00:00:00", "")


def rows_of(df):
    return sorted(tuple(map(text, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, tables, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    sql = entry.oracle_sql()[name]
    want = tables.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["merge_precedence", "upsert_newer", "queue_take", "object_changes", "stale_runs", "top_users"])
def test_plans_stay_in_the_jvm(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
