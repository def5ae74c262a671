"""Nested documents to flat rows, and the guards and drift reports that go with it."""

from __future__ import annotations

import functools
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_header(df: DataFrame, fields: Mapping[str, str], counts: Mapping[str, str] | None = None, day: str | None = None) -> DataFrame:
    """One row a document: fields by path, the lengths of arrays (null for a null array), and the source day."""
    picked = [F.col(path).alias(name) for name, path in fields.items()]
    lengths = [F.when(F.col(path).isNotNull(), F.size(path)).alias(name) for name, path in (counts or {}).items()]
    return df.select(*picked, *lengths, *([F.col(day)] if day else []))


def explode_ordinal(df: DataFrame, array: str, keys: list[str], fields: Mapping[str, str]) -> DataFrame:
    """One row an element, with a 1-based ordinal in the array's order; no element, no row."""
    each = df.select(*[F.col(k).alias(k.split(".")[-1]) for k in keys], F.posexplode(array).alias("ordinal", "e"))
    own = [k.split(".")[-1] for k in keys]
    return each.select(*own, (F.col("ordinal") + 1).alias("ordinal"), *[F.col(f"e.{path}").alias(name) for name, path in fields.items()])


def explode_two_levels(df: DataFrame, array: str, keys: list[str], fields: Mapping[str, str], inner: str, inner_schema: str) -> DataFrame:
    """Both levels in one table: parent_ordinal is null at the top, and the container's ordinal inside.

    inner names the text field that holds the second level's JSON. Where inner_schema has that field too, as text, a third
    level in it fails the job in the same pass (assert_max_depth() needs a parse of its own).
    """
    guarded = any(f.name == inner for f in T._parse_datatype_string(inner_schema).elementType.fields)

    def level(e: Column, parent: Column, ordinal: Column) -> Column:
        own = [functools.reduce(Column.getField, path.split("."), e).alias(name) for name, path in fields.items()]
        return F.struct(parent.cast("int").alias("parent_ordinal"), ordinal.alias("ordinal"), *own)

    def checked(e: Column, row: Column) -> Column:
        if not guarded:
            return row
        deeper = F.coalesce(F.json_array_length(e[inner]), F.lit(0)) > 0
        return F.when(deeper, F.raise_error(F.concat(F.lit("third level in "), e[inner]))).otherwise(row)

    def both(e: Column, i: Column) -> Column:
        top = F.array(level(e, F.lit(None), i + 1))
        below = F.transform(F.from_json(e[inner], inner_schema, {"mode": "FAILFAST"}), lambda x, j: checked(x, level(x, i + 1, j + 1)))
        return F.concat(top, F.coalesce(below, F.slice(top, 1, 0)))

    own = [F.col(k).alias(k.split(".")[-1]) for k in keys]
    return df.select(*own, F.inline(F.flatten(F.transform(F.col(array), both))))


def too_deep(inner: Column, array: str) -> Column:
    """How many elements of an inner array's JSON text hold an array of that name themselves."""
    elements = F.from_json(inner, "array<string>")
    return F.coalesce(F.size(F.filter(elements, lambda e: F.coalesce(F.json_array_length(F.get_json_object(e, f"$.{array}")), F.lit(0)) > 0)), F.lit(0))


def depth_violations(df: DataFrame, array: str, keys: list[str], inner: str) -> DataFrame:
    """(keys, violations) of the documents with a third level."""
    own = [F.col(k).alias(k.split(".")[-1]) for k in keys]
    total = F.aggregate(F.transform(F.col(array), lambda e: too_deep(e[inner], inner)), F.lit(0), lambda a, x: a + x)
    return df.select(*own, total.alias("violations")).filter("violations > 0")


def assert_max_depth(df: DataFrame, array: str, inner: str) -> DataFrame:
    """df, failing in the same pass on the first document with a third level."""
    total = F.aggregate(F.transform(F.col(array), lambda e: too_deep(e[inner], inner)), F.lit(0), lambda a, x: a + x)
    return df.filter(F.when(F.coalesce(total, F.lit(0)) > 0, F.raise_error(F.concat(F.lit("third level in "), total.cast("string"), F.lit(" places")))).otherwise(F.lit(True)).cast("boolean"))


def unknown_keys_by_day(df: DataFrame, objects: Column, known: list[str], day: str) -> DataFrame:
    """(day, unknown_keys): the keys of JSON objects (an array of them a row) that the contract doesn't know, sorted, for the manifest."""
    each = df.select(day, F.explode(objects).alias("o")).select(day, F.explode(F.json_object_keys("o")).alias("k"))
    return each.filter(~F.col("k").isin(known)).groupBy(day).agg(F.sort_array(F.collect_set("k")).alias("unknown_keys"))


def unknown_keys(df: DataFrame, scopes: Mapping[str, Column], expected: Mapping[str, list[str]]) -> DataFrame:
    """(scope, key, documents): keys of JSON objects that aren't expected, by scope; reported, not fatal.

    scopes: for each scope an array of the JSON texts of the objects to look at. One pass over df.
    """
    pairs = F.flatten(F.array(*[_scoped(scope, objects) for scope, objects in scopes.items()]))
    found = df.select(F.explode(pairs).alias("p")).groupBy("p.scope", "p.key").agg(F.count("*").alias("documents"))
    for scope, known in expected.items():
        found = found.filter(~((F.col("scope") == scope) & F.col("key").isin(*known)) if known else F.lit(True))
    return found


def _scoped(scope: str, objects: Column) -> Column:
    none = F.expr("cast(array() AS array<string>)")
    keys = F.array_distinct(F.flatten(F.transform(F.coalesce(objects, none), lambda o: F.coalesce(F.json_object_keys(o), none))))
    return F.transform(keys, lambda k: F.struct(F.lit(scope).alias("scope"), k.alias("key")))


def assert_same_count(parsed: int, documents: int) -> None:
    """Rows parsed must be documents read; sinks.stage_counted() observes both in one job."""
    if parsed != documents:
        raise ValueError(f"{parsed} rows from {documents} documents")


def assert_single_day(df: DataFrame, column: str, day) -> DataFrame:
    """df, failing in the same pass on a row of another day."""
    other = ~F.col(column).eqNullSafe(F.lit(day).cast("date"))
    return df.filter(F.when(other, F.raise_error(F.concat(F.lit("a row of "), F.coalesce(F.col(column).cast("string"), F.lit("no day"))))).otherwise(F.lit(True)).cast("boolean"))
