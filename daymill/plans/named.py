"""Named read queries with declared, typed parameters."""

from __future__ import annotations

import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Query(NamedTuple):
    text: str
    params: dict[str, tuple[str, bool]]  # kind (date, int, ids, str) and whether it is required


_RANGE = {"date_from": ("date", True), "date_to": ("date", True)}
NAMED = {
    "header_by_date": Query("SELECT * FROM headers WHERE day BETWEEN :date_from AND :date_to ORDER BY day, id", _RANGE),
    "child_by_date": Query("SELECT * FROM children WHERE day BETWEEN :date_from AND :date_to ORDER BY day, id, ordinal", _RANGE),
    "items_by_date": Query("SELECT * FROM items WHERE day BETWEEN :date_from AND :date_to ORDER BY day, id, parent_ordinal NULLS FIRST, ordinal", _RANGE),
    "market_by_date": Query("SELECT * FROM market WHERE day BETWEEN :date_from AND :date_to AND (:region_id IS NULL OR region_id = :region_id) ORDER BY day, region_id, id", _RANGE | {"region_id": ("int", False)}),
    "members_by_id": Query("SELECT * FROM members WHERE array_contains(CAST(:ids AS ARRAY<BIGINT>), CAST(id AS BIGINT)) ORDER BY id", {"ids": ("ids", True)}),
    "groups_by_id": Query("SELECT * FROM groups WHERE array_contains(CAST(:ids AS ARRAY<BIGINT>), CAST(id AS BIGINT)) ORDER BY id", {"ids": ("ids", True)}),
    "parents_by_id": Query("SELECT * FROM parents WHERE array_contains(CAST(:ids AS ARRAY<BIGINT>), CAST(id AS BIGINT)) ORDER BY id", {"ids": ("ids", True)}),
    "history_by_id": Query("SELECT * FROM history WHERE array_contains(CAST(:ids AS ARRAY<BIGINT>), CAST(id AS BIGINT)) ORDER BY id, record_id", {"ids": ("ids", True)}),
    "group_history_by_id": Query("SELECT * FROM group_history WHERE array_contains(CAST(:ids AS ARRAY<BIGINT>), CAST(id AS BIGINT)) ORDER BY id, record_id", {"ids": ("ids", True)}),
}


def convert(kind: str, value: str):
    """A parameter's text as a value; a ValueError if it can't be read."""
    if kind == "date":
        return datetime.date.fromisoformat(value)
    if kind == "int":
        return int(value)
    if kind == "ids":
        return sorted({int(x) for x in value.split(",") if x.strip()})
    return value


def run_named(spark: SparkSession, name: str, params: dict[str, str]) -> DataFrame:
    """A named query over the registered views; bounds of days reach the scan as filters."""
    if name not in NAMED:
        raise ValueError(f"unknown query {name}")
    text, declared = NAMED[name]
    if unknown := sorted(set(params) - set(declared)):
        raise ValueError(f"unknown parameter {unknown[0]}")
    args = {}
    for p, (kind, required) in declared.items():
        if p in params:
            value = convert(kind, params[p])
            args[p] = F.array(*map(F.lit, value)) if kind == "ids" else value
        elif required:
            raise ValueError(f"parameter {p} is missing")
        else:
            args[p] = None
    return spark.sql(text, args=args)


def top_groups(df: DataFrame, group: str, n: int = 10) -> DataFrame:
    """The n groups with the most rows; the group breaks ties."""
    return df.groupBy(group).agg(F.count("*").alias("n_rows")).orderBy(F.col("n_rows").desc(), F.col(group)).limit(n)
