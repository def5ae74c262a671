"""Upstream objects and their revisions: what is new, what changed since a time, what to check or import again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OBJECT = ["dataset", "object_key"]
#: States of objects that wait for an import, and runs that serve the same other copy before it counts.
PENDING = ("discovered", "changed", "fetched", "failed", "provisional")
PROVISIONAL_RUNS = 3


def differs(seen: dict[str, Column], stored: dict[str, Column]) -> Column:
    """Whether tag, size or time to the second differ."""
    time = ~F.date_trunc("SECOND", seen["last_modified"]).eqNullSafe(F.date_trunc("SECOND", stored["last_modified"]))
    return ~seen["etag"].eqNullSafe(stored["etag"]) | ~seen["size"].eqNullSafe(stored["size"]) | time


def classify_objects(seen: DataFrame, stored: DataFrame) -> DataFrame:
    """(dataset, object_key, change) of seen objects: new, changed (or gone before), unchanged."""
    s = stored.select(*OBJECT, F.col("etag").alias("s_etag"), F.col("size").alias("s_size"), F.col("last_modified").alias("s_time"), F.col("status").alias("s_status"))
    j = seen.join(s, OBJECT, "left")
    other = differs({c: F.col(c) for c in ("etag", "size", "last_modified")}, {"etag": F.col("s_etag"), "size": F.col("s_size"), "last_modified": F.col("s_time")})
    change = F.when(F.col("s_status").isNull(), "new").when(other | (F.col("s_status") == "gone"), "changed").otherwise("unchanged")
    return j.select(*OBJECT, change.alias("change"))


def missing_objects(seen: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored objects that a full listing no longer has."""
    return stored.filter("status <> 'gone'").join(seen, OBJECT, "left_anti").select(*OBJECT)


def parser_outdated(objects: DataFrame, revisions: DataFrame, version: int) -> DataFrame:
    """Imported objects whose current revision an older parser made."""
    r = revisions.select(*OBJECT, F.col("revision").alias("current_revision"), "parser_version")
    return objects.filter("status = 'imported'").join(r, [*OBJECT, "current_revision"]).filter(F.col("parser_version") < version).select(*OBJECT)


def force(objects: DataFrame, date_from, date_to) -> DataFrame:
    """Imported objects of a range, to be imported again."""
    return objects.filter("status = 'imported'").filter(F.col("logical_date").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))).select(*OBJECT)


def add_revisions(new: DataFrame, revisions: DataFrame, order: list[str]) -> DataFrame:
    """new with the next revision numbers of their objects, in the given order."""
    last = revisions.groupBy(*OBJECT).agg(F.max("revision").alias("__last"))
    n = F.row_number().over(Window.partitionBy(*OBJECT).orderBy(*order))
    return new.join(last, OBJECT, "left").withColumn("revision", F.coalesce("__last", F.lit(0)) + n).drop("__last")


def current_revisions(log: DataFrame) -> DataFrame:
    """log with state: of an object's promoted revisions the newest is imported, earlier ones superseded; others pending."""
    newest = F.max(F.when(F.col("imported_at").isNotNull(), F.col("revision"))).over(Window.partitionBy(*OBJECT))
    state = F.when(F.col("imported_at").isNull(), "pending").when(F.col("revision") == newest, "imported").otherwise("superseded")
    return log.withColumn("state", state)


def changed_since(objects: DataFrame, revisions: DataFrame, since) -> DataFrame:
    """Objects whose current revision was imported after a time, oldest import first."""
    r = revisions.select(*OBJECT, F.col("revision").alias("current_revision"), "imported_at")
    j = objects.join(r, [*OBJECT, "current_revision"]).filter(F.col("imported_at") > F.lit(since).cast("timestamp"))
    return j.select(*OBJECT, "logical_date", "current_revision", "imported_at").orderBy("imported_at", *OBJECT)


def list_objects(objects: DataFrame, dataset: str | None = None, statuses: list[str] | None = None, date_from=None, date_to=None) -> DataFrame:
    """Objects by dataset, states and days, newest first, those without a day last."""
    out = objects
    if dataset is not None:
        out = out.filter(F.col("dataset") == dataset)
    if statuses:
        out = out.filter(F.col("status").isin(*statuses))
    if date_from is not None:
        out = out.filter(F.col("logical_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        out = out.filter(F.col("logical_date") <= F.lit(date_to).cast("date"))
    return out.orderBy(F.col("logical_date").desc_nulls_last(), *OBJECT)


def dataset_summary(objects: DataFrame) -> DataFrame:
    """(dataset, n_objects, by_status, first_day, last_day): counts by state, and the imported range of days."""
    counts = objects.groupBy("dataset", "status").agg(F.count("*").alias("n"), F.min("logical_date").alias("a"), F.max("logical_date").alias("b"))
    imported = F.col("status") == "imported"
    return counts.groupBy("dataset").agg(
        F.sum("n").alias("n_objects"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "status", F.col("n").cast("string")))), ",").alias("by_status"),
        F.min(F.when(imported, F.col("a"))).alias("first_day"),
        F.max(F.when(imported, F.col("b"))).alias("last_day"),
    )


def object_detail(objects: DataFrame, revisions: DataFrame, dataset: str, object_key: str) -> DataFrame:
    """An object with its chain of revisions in order."""
    one = objects.filter((F.col("dataset") == dataset) & (F.col("object_key") == object_key))
    return one.select(*OBJECT, "status", "current_revision").join(revisions, OBJECT, "left").orderBy("revision")


def select_recheck(seen: DataFrame, stored: DataFrame, today, young_days: int, checked_after, date_from=None, date_to=None) -> DataFrame:
    """seen with recheck, and the validators to ask with.

    Checked again: in a named range, new, pending and not checked just now, provisional, of a changed listing, or
    young. An object of an unchanged listing that isn't checked keeps the stored validators.
    """
    s = stored.select(*OBJECT, F.col("status").alias("s_status"), F.col("etag").alias("s_etag"), F.col("last_seen_at"))
    j = seen.join(s, OBJECT, "left")
    in_range = F.lit(False)
    if date_from is not None:
        in_range = F.col("logical_date").between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))
    pending = F.col("s_status").isin(*PENDING) & (F.col("last_seen_at") < F.lit(checked_after).cast("timestamp"))
    young = F.datediff(F.lit(today).cast("date"), "logical_date") < young_days
    asked = in_range | F.col("s_status").isNull() | pending | (F.col("s_status") == "provisional") | ~F.col("listing_unchanged") | young
    j = j.withColumn("recheck", F.coalesce(asked, F.lit(False)))
    kept = F.when(~F.col("recheck") & F.col("listing_unchanged"), F.col("s_etag")).otherwise(F.col("etag"))
    return j.select(*OBJECT, "logical_date", "recheck", kept.alias("etag"))


def pending_objects(objects: DataFrame, unsupported: dict[str, str], n: int) -> DataFrame:
    """The first n waiting objects, newest first, with the reason why a name isn't supported (null if it is)."""
    reason = F.lit(None).cast("string")
    for part, why in unsupported.items():
        reason = F.when(F.col("object_key").contains(part), F.lit(why)).otherwise(reason)
    out = objects.filter(F.col("status").isin(*PENDING)).withColumn("reason", reason)
    return out.orderBy(F.col("logical_date").desc_nulls_last(), *OBJECT).limit(n)


def plan_import(objects: DataFrame, revisions: DataFrame, version: int) -> DataFrame:
    """(dataset, object_key, action, revision): reuse if the live revision has this tag and parser; else replay the
    newest kept raw file with the tag; else fetch."""
    live = revisions.select(*OBJECT, F.col("revision").alias("current_revision"), F.col("upstream_etag").alias("live_etag"), F.col("parser_version").alias("live_parser"))
    same = revisions.filter("raw_path IS NOT NULL").groupBy(*OBJECT, F.col("upstream_etag").alias("etag")).agg(F.max("revision").alias("kept"))
    j = objects.join(live, [*OBJECT, "current_revision"], "left").join(same, [*OBJECT, "etag"], "left")
    reuse = (F.col("live_etag") == F.col("etag")) & (F.col("live_parser") == version)
    action = F.when(reuse, "reuse").when(F.col("kept").isNotNull(), "replay").otherwise("fetch")
    revision = F.when(reuse, F.col("current_revision")).otherwise(F.col("kept"))
    return j.select(*OBJECT, action.alias("action"), revision.alias("revision"))


def stale_runs(observations: DataFrame, key: list[str], order: list[str], tag: str, current: str) -> DataFrame:
    """observations with stale_runs and provisional: how many runs in a row have served the same other tag."""
    w = Window.partitionBy(*key).orderBy(*order)
    new = F.coalesce((F.lag(tag).over(w) != F.col(tag)).cast("int"), F.lit(1))
    numbered = observations.withColumn("__island", F.sum(new).over(w))
    run = F.row_number().over(Window.partitionBy(*key, "__island").orderBy(*order))
    out = numbered.withColumn("stale_runs", F.when(F.col(tag) == F.col(current), 0).otherwise(run)).drop("__island")
    return out.withColumn("provisional", F.col("stale_runs") >= PROVISIONAL_RUNS)


def verified(expected: Column, observed: Column) -> Column:
    """Whether the counts agree; null without an expectation."""
    return F.when(expected.isNotNull(), expected.eqNullSafe(observed))


def sweep_slice(objects: DataFrame, cursor: str | None, n: int) -> DataFrame:
    """The next n keys of a sweep after a cursor; an empty result completes the pass."""
    out = objects.select("object_key").distinct()
    if cursor is not None:
        out = out.filter(F.col("object_key") > cursor)
    return out.orderBy("object_key").limit(n)


def list_runs(runs: DataFrame, job: str | None = None, n: int = 50, unfinished: bool = False) -> DataFrame:
    """The newest n runs, of one job or all; or those that haven't finished."""
    out = runs if job is None else runs.filter(F.col("job") == job)
    if unfinished:
        out = out.filter("finished_at IS NULL")
    return out.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(n)
