"""A prioritised work queue as a table: (kind, entity_id, priority, last_refreshed_at, next_due_at, etag, failures, last_error)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["kind", "entity_id"]
#: Priority classes, and how far off an entry is due after each outcome.
IDLE, DEFERRED = 9, 8
DONE_DAYS, REFUSED_DAYS = 3650, 365


def push(queue: DataFrame, entries: DataFrame) -> DataFrame:
    """queue with entries merged in by key: the better priority and the earlier due time; other fields stay."""
    batch = entries.groupBy(*KEY).agg(F.min("priority").alias("p"), F.min("next_due_at").alias("d"))
    j = queue.join(batch, KEY, "full_outer")
    kept = [F.col(c) for c in queue.columns if c not in (*KEY, "priority", "next_due_at", "failures")]
    out = j.select(*KEY, F.least("priority", "p").alias("priority"), F.least("next_due_at", "d").alias("next_due_at"), *kept, F.coalesce("failures", F.lit(0)).alias("failures"))
    return out.select(*queue.columns)


def take(queue: DataFrame, now, limit: int) -> DataFrame:
    """Due entries, fairly: by priority, then kinds in turn, then due time and kind; entries stay in the queue.

    Inside a kind never refreshed ones come first, then the stalest, the earliest due, the smallest id. Only the best
    limit of each kind and priority can be taken, so ranks are cut there before they are ordered together.
    """
    due = queue.filter(F.col("next_due_at") <= F.lit(now).cast("timestamp"))
    turn = Window.partitionBy("priority", "kind").orderBy(F.col("last_refreshed_at").asc_nulls_first(), "next_due_at", "entity_id")
    ranked = due.withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= limit)
    return ranked.orderBy("priority", "turn", "next_due_at", "kind").limit(limit)


def worth_queueing(ids: DataFrame, queue: DataFrame, before=None) -> DataFrame:
    """(kind, entity_id) with no entry, or, with a cutoff, never refreshed or refreshed before it."""
    j = ids.select(*KEY).distinct().join(queue.select(*KEY, "last_refreshed_at", F.lit(True).alias("there")), KEY, "left")
    wanted = F.col("there").isNull()
    if before is not None:
        wanted = wanted | F.col("last_refreshed_at").isNull() | (F.col("last_refreshed_at") < F.lit(before).cast("timestamp"))
    return j.filter(wanted).select(*KEY)


def counts(queue: DataFrame, now) -> DataFrame:
    """(priority, n_entries, n_due)."""
    return queue.groupBy("priority").agg(F.count("*").alias("n_entries"), F.count_if(F.col("next_due_at") <= F.lit(now).cast("timestamp")).alias("n_due"))


def defer(queue: DataFrame, stored: DataFrame, crawl: int) -> DataFrame:
    """queue with the crawl entries of deleted or unknown entities in the deferred class. stored: (kind, entity_id, deleted)."""
    j = queue.join(stored.select(*KEY, F.col("deleted").alias("__gone")), KEY, "left")
    off = (F.col("priority") == crawl) & F.coalesce("__gone", F.lit(True))
    return j.withColumn("priority", F.when(off, F.lit(DEFERRED)).otherwise(F.col("priority"))).select(*queue.columns)


def within_budget(queue: DataFrame, now, budget: int, cost: dict[str, int], stored: DataFrame | None = None, light: Sequence[int] = ()) -> DataFrame:
    """All entries, in fair order, whose running cost stays within the budget; it stops before the first that exceeds it.

    cost: requests by kind, at least 1 each (1 for a kind without one). Entries of the light priorities cost 1 if they are
    among stored (kind, entity_id): of these only the history is read. So a budget never pays for more than budget
    entries, and the running sum goes over that many at most, not over the queue.
    """
    if low := sorted(kind for kind, n in cost.items() if n < 1):
        raise ValueError(f"cost of {low[0]} is below 1")
    price = F.lit(1)
    for kind, n in cost.items():
        price = F.when(F.col("kind") == kind, n).otherwise(price)
    page = take(queue, now, max(budget, 0))
    if stored is not None and light:
        page = page.join(stored.select(*KEY).distinct().withColumn("__known", F.lit(True)), KEY, "left")
        price = F.when(F.col("priority").isin(*light) & F.col("__known").isNotNull(), 1).otherwise(price)
        page = page.withColumn("cost", price).drop("__known")
    else:
        page = page.withColumn("cost", price)
    order = Window.orderBy("priority", "turn", "next_due_at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    return page.withColumn("spent", F.sum("cost").over(order)).filter(F.col("spent") <= budget)


#: Refusals that are tried again like failures, and those that stop all work and leave entries alone.
RETRIED, STOPPED = (408, 429), (403, 420)


def apply_outcomes(queue: DataFrame, outcomes: DataFrame) -> DataFrame:
    """queue after outcomes (kind, entity_id, at, status, error).

    ok: idle, due in ten years, failures and error cleared; gone (404, 410) or refused (another 4xx): idle, due in a
    year, the failure counted; 403 and 420 stop all work: the entry stays as it is; anything else, 408 and 429 too: same
    priority, due in an hour doubled by each failure up to a day.
    """
    j = queue.join(outcomes, KEY, "left")
    none, ok = F.col("status").isNull() | F.col("status").isin(*STOPPED), F.col("status").between(200, 399)
    refused = F.col("status").between(400, 499) & ~F.col("status").isin(*RETRIED, *STOPPED)
    failed = F.coalesce("failures", F.lit(0)) + 1
    hours = F.least(F.pow(F.lit(2.0), failed - 1), F.lit(24.0)).cast("int")
    later = lambda days: F.col("at") + F.make_interval(days=F.lit(days))
    new = {
        "priority": F.when(none, F.col("priority")).when(ok | refused, F.lit(IDLE)).otherwise(F.col("priority")),
        "last_refreshed_at": F.when(ok | refused, F.col("at")).otherwise(F.col("last_refreshed_at")),
        "next_due_at": F.when(none, F.col("next_due_at")).when(ok, later(DONE_DAYS)).when(refused, later(REFUSED_DAYS)).otherwise(F.col("at") + F.make_interval(hours=hours)),
        "failures": F.when(none, F.col("failures")).when(ok, F.lit(0)).otherwise(failed),
        "last_error": F.when(none, F.col("last_error")).when(ok, F.lit(None)).otherwise(F.substring("error", 1, 500)),
    }
    return j.select(*[(new[c].cast(queue.schema[c].dataType) if c in new else F.col(c)).alias(c) for c in queue.columns])


def below_mark(queue: DataFrame, now, crawl: int, low_water: int) -> DataFrame:
    """One row with low: whether fewer than low_water entries of the crawl class are due."""
    due = (F.col("priority") == crawl) & (F.col("next_due_at") <= F.lit(now).cast("timestamp"))
    return queue.agg((F.count_if(due) < low_water).alias("low"))


def crawl_facts(queue: DataFrame, fact_ids: DataFrame, now, crawl: int, low_water: int) -> DataFrame:
    """(kind, entity_id) of the crawl's first step: all ids that facts name and that have no entry, if the class is low.

    Their order, highest id first in each kind, is the queue's when it is read.
    """
    low = F.broadcast(below_mark(queue, now, crawl, low_water))  # one row
    return worth_queueing(fact_ids, queue).join(low, F.col("low")).select(*KEY)


def crawl_pages(queue: DataFrame, live: DataFrame, now, crawl: int, low_water: int, n: int, cursors: DataFrame | None = None) -> DataFrame:
    """(kind, entity_id, cursor) of the crawl's second step, if the class is low: for each kind, whole pages of n live ids.

    Pages go from the cursor (kind, cursor) downwards, by highest id first, until n ids without an entry are found; these
    are returned, with the cursor to go on from: the last id of the last page, or -1 when no ids are left. A kind at -1
    is done. A kind whose last pages give nothing has one row with a null id, for its cursor.
    """
    rest = live.select(*KEY).distinct()
    if cursors is not None:
        rest = rest.join(F.broadcast(cursors.select("kind", "cursor")), "kind", "left").filter(F.col("cursor").isNull() | (F.col("entity_id") < F.col("cursor"))).drop("cursor")
    wanted = worth_queueing(rest, queue)
    place = F.row_number().over(Window.partitionBy("kind").orderBy(F.col("entity_id").desc()))
    top = wanted.withColumn("place", place).filter(F.col("place") <= n)  # ranks are cut before the shuffle
    nth = top.groupBy("kind").agg(F.min("entity_id").alias("nth"), F.max("place").alias("found")).filter(F.col("found") >= n).select("kind", "nth")
    nth = F.broadcast(nth)  # like all that follows but the ids, one row a kind
    # the page that holds the n-th id ends with the live id whose rank is the next multiple of n
    at = rest.join(nth, "kind")
    rank = at.filter("entity_id >= nth").groupBy("kind").agg(F.count("*").alias("rank"))
    lower = at.filter("entity_id < nth").withColumn("place", place).filter(F.col("place") < n)
    lower = lower.join(F.broadcast(rank), "kind").filter(F.col("place") <= F.pmod(-F.col("rank"), F.lit(n)))
    ends = nth.join(lower.groupBy("kind").agg(F.min("entity_id").alias("low_id")), "kind", "left").select("kind", F.coalesce("low_id", "nth").alias("cursor"))
    kinds = live.select("kind").distinct()
    if cursors is not None:
        kinds = kinds.join(cursors.filter("cursor = -1"), "kind", "left_anti")
    ends = kinds.join(ends, "kind", "left").select("kind", F.coalesce("cursor", F.lit(-1)).alias("cursor"))
    low = F.broadcast(below_mark(queue, now, crawl, low_water))  # one row
    taken = wanted.withColumnRenamed("kind", "__kind")
    found = taken.join(F.broadcast(ends), (F.col("kind") == F.col("__kind")) & (F.col("entity_id") >= F.col("cursor")))
    found = found.select("kind", "entity_id", "cursor")
    bare = ends.join(F.broadcast(found.select("kind").distinct()), "kind", "left_anti").select("kind", F.lit(None).cast("long").alias("entity_id"), "cursor")
    return found.unionByName(bare).join(low, F.col("low")).select("kind", "entity_id", F.col("cursor").cast("long").alias("cursor"))


def queue_active(queue: DataFrame, recent_ids: DataFrame, stale_before, priority: int, now) -> DataFrame:
    """Entries to push for entities on recent facts whose details are stale."""
    return worth_queueing(recent_ids, queue, stale_before).select(*KEY, F.lit(priority).alias("priority"), F.lit(now).cast("timestamp").alias("next_due_at"))
