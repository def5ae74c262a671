"""Several sources merged to one row per id and event day by precedence; children follow the chosen parent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rank_of(source: Column, order: list[str]) -> Column:
    """A source's place in the order of precedence; sources that aren't listed come last."""
    out = F.lit(len(order))
    for i, s in enumerate(order):
        out = F.when(source == s, i).otherwise(out)
    return out


def union_sources(sources: dict[str, DataFrame | None], order: list[str]) -> DataFrame:
    """All sources in one table with their name and rank; those without data are left out."""
    parts = [df.withColumn("source", F.lit(s)) for s, df in sources.items() if df is not None]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("rank", rank_of(F.col("source"), order))


def merge_by_precedence(df: DataFrame, key: str, day: str, source_date: str, order: list[str], spill: int = 1) -> DataFrame:
    """One row per id and event day, with all sources that have it, sorted, in sources.

    The source of the lowest rank gives the row, then its earliest source date. Rows without a day never merge, nor do
    rows of source dates further than spill days from their event day.
    """
    near = df.filter(F.col(day).isNotNull() & (F.abs(F.datediff(source_date, day)) <= spill))
    # aggregates, not windows: rows of one id and day are combined before the shuffle
    first = F.min_by(F.struct(*near.columns), F.struct(rank_of(F.col("source"), order), F.col(source_date)))
    merged = near.groupBy(F.col(day).alias("__day"), F.col(key).alias("__key")).agg(first.alias("__first"), F.array_sort(F.collect_set("source")).alias("sources"))
    return merged.select("__first.*", "sources")


def children_of_chosen(children: DataFrame, chosen: DataFrame, key: str, source_date: str = "source_date", day: str = "day") -> DataFrame:
    """The children of chosen rows: same id, source and source date; they get the chosen row's day."""
    keys = chosen.select(key, "source", source_date, day)
    return children.join(keys, [key, "source", source_date])


def affected_days(days: DataFrame, day: str = "day", spill: int = 1) -> DataFrame:
    """The merged days that a change to these source days can touch."""
    return days.select(F.explode(F.sequence(F.date_sub(day, spill), F.date_add(day, spill))).alias(day)).distinct()


def merge_range(df: DataFrame, key: str, day: str, source_date: str, order: list[str], date_from=None, date_to=None, spill: int = 1) -> DataFrame:
    """The merge of a range of event days in one job, from the source days that can hold their rows."""
    near = df
    if date_from is not None:
        near = near.filter(F.col(source_date) >= F.date_sub(F.lit(date_from).cast("date"), spill)).filter(F.col(day) >= F.lit(date_from).cast("date"))
    if date_to is not None:
        near = near.filter(F.col(source_date) <= F.date_add(F.lit(date_to).cast("date"), spill)).filter(F.col(day) <= F.lit(date_to).cast("date"))
    return merge_by_precedence(near, key, day, source_date, order, spill)


def merge_report(merged: DataFrame, day: str) -> DataFrame:
    """(day, n_rows, n_shared, only): rows, rows that several sources have, and per source rows that it alone has."""
    single = F.when(F.size("sources") == 1, F.col("sources")[0])
    counts = merged.groupBy(day, single.alias("only")).agg(F.count("*").alias("n"))
    return counts.groupBy(day).agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("only").isNull(), F.col("n"))), F.lit(0)).alias("n_shared"),
        F.array_join(F.array_sort(F.collect_list(F.when(F.col("only").isNotNull(), F.concat_ws("=", "only", F.col("n").cast("string"))))), ",").alias("only"),
    )


def built_from(df: DataFrame, day: str, source_date: str, spill: int = 1) -> DataFrame:
    """(day, built_from): the source partitions that a merged day was built from, as source/date, sorted."""
    near = df.filter(F.col(day).isNotNull() & (F.abs(F.datediff(source_date, day)) <= spill))
    parts = near.select(day, "source", source_date).distinct()
    return parts.groupBy(day).agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("/", "source", F.col(source_date).cast("string")))), ",").alias("built_from"))
