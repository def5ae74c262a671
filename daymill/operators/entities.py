"""Entity tables: upserts where the newer observation wins, reads by key, and differences between snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .workqueue import worth_queueing


def upsert_newer(base: DataFrame, incoming: DataFrame, keys: list[str], ts: str = "observed_at", required: Sequence[str] = ()) -> DataFrame:
    """base with incoming merged in: per key the newest row; a tie with a stored row goes to the incoming one.

    Incoming rows that tie among themselves are ordered by all their columns, so the result doesn't depend on the
    order of arrival. A missing required column is an error.
    """
    if missing := [c for c in (*keys, ts, *required) if c not in incoming.columns]:
        raise ValueError(f"column {missing[0]} is missing")
    both = base.withColumn("__side", F.lit(0)).unionByName(incoming.withColumn("__side", F.lit(1)))
    rest = [F.col(c).desc_nulls_last() for c in base.columns if c not in keys and c != ts]
    newest = Window.partitionBy(*keys).orderBy(F.col(ts).desc_nulls_last(), F.col("__side").desc(), *rest)
    return both.withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n", "__side")


def seed_all(base: DataFrame, snapshots: list[DataFrame], keys: list[str], ts: str = "observed_at") -> DataFrame:
    """Several snapshots in any order with one result: one union and one upsert."""
    if not snapshots:
        return base
    union = snapshots[0]
    for s in snapshots[1:]:
        union = union.unionByName(s)
    return upsert_newer(base, union, keys, ts)


def lookup(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows of the given ids, ordered by key."""
    return df.join(ids.select(key).distinct(), key, "left_semi").orderBy(key)


def id_page(df: DataFrame, key: str, live_only: bool = False, where: dict[str, int] | None = None, after=None, descending: bool = False, limit: int | None = None) -> DataFrame:
    """A keyset page of distinct ids, strictly after (before, if descending) a cursor."""
    out = df.filter("NOT deleted") if live_only else df
    for c, v in (where or {}).items():
        out = out.filter(F.col(c) == v)
    if after is not None:
        out = out.filter(F.col(key) < after if descending else F.col(key) > after)
    out = out.select(key).distinct().orderBy(F.col(key).desc() if descending else F.col(key))
    return out.limit(limit) if limit is not None else out


def latest_per_entity(df: DataFrame, entity: str, start: str = "start_date", record: str = "record_id") -> DataFrame:
    """The newest history record of each entity; the record id breaks ties."""
    newest = Window.partitionBy(entity).orderBy(F.col(start).desc_nulls_last(), F.col(record).desc_nulls_last())
    return df.withColumn("__n", F.row_number().over(newest)).filter("__n = 1").drop("__n")


def latest_value(df: DataFrame, entity: str, value: str, start: str = "start_date", record: str = "record_id") -> DataFrame:
    """(entity, value) of the newest record, null if its value is null."""
    return df.groupBy(entity).agg(F.max_by(value, F.struct(start, record)).alias(value))


def history_mismatch(current: DataFrame, history: DataFrame, entity: str, value: str, start: str = "start_date", record: str = "record_id") -> DataFrame:
    """(entity, current_value, history_value) where the current value isn't the newest record's."""
    newest = latest_per_entity(history, entity, start, record).select(entity, F.col(value).alias("history_value"))
    now = current.select(entity, F.col(value).alias("current_value"))
    return now.join(newest, entity).filter(~F.col("current_value").eqNullSafe(F.col("history_value")))


def ids_from_facts(facts: list[tuple[DataFrame, dict[str, str]]], day: str | None = None, date_from=None, date_to=None) -> DataFrame:
    """(kind, id): distinct positive ids of each kind. facts: tables with kind by id column; day bounds are inclusive."""
    out = None
    for df, columns in facts:
        if day and day in df.columns:
            df = df.filter(F.col(day).between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date")))
        pairs = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(c).cast("long").alias("id")) for c, kind in columns.items()])
        each = df.select(F.explode(pairs).alias("p")).select("p.kind", "p.id").filter("id > 0").distinct()
        out = each if out is None else out.unionByName(each)
    return out.distinct()


def unknown_ids(listed: DataFrame, stored: DataFrame) -> DataFrame:
    """(kind, id) listed and not stored."""
    return listed.select("kind", "id").distinct().join(stored, ["kind", "id"], "left_anti")


def new_since(listed: DataFrame, key: str, highest: int) -> DataFrame:
    """The listed ids past the highest known one, in order."""
    return listed.select(key).distinct().filter(F.col(key) > highest).orderBy(key)


AFFILIATION = ("group_id", "parent_id", "title")


def classify_affiliation(results: DataFrame, stored: DataFrame, key: str, closed_group: int) -> DataFrame:
    """results with class, the first that fits, and changed (whether the entity is to be read again).

    results: (key, valid, group_id, parent_id, title); stored adds deleted; a result without a key is left out. invalid:
    a live stored row that the source refuses; unknown: not stored; moved_to_deleted: now in the group of closed ones,
    and not yet stored so; restored_or_moved: stored as deleted, or in another group; attributes_only: parent or title
    differ; same. Only unknown and restored_or_moved are changed.
    """
    s = stored.select(F.col(key), *[F.col(c).alias(f"s_{c}") for c in (*AFFILIATION, "deleted")], F.lit(True).alias("there"))
    j = results.filter(F.col(key).isNotNull()).join(s, key, "left")
    known = F.col("there").isNotNull()
    same = {c: F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in AFFILIATION}
    closed = F.coalesce(F.col("group_id") == closed_group, F.lit(False))
    kind = (
        F.when(~F.col("valid") & known & ~F.col("s_deleted"), "invalid")
        .when(~F.col("valid"), "same")
        .when(~known, "unknown")
        .when(closed & F.col("s_deleted") & same["group_id"], "same")
        .when(closed, "moved_to_deleted")
        .when(F.col("s_deleted") | ~same["group_id"], "restored_or_moved")
        .when(~same["parent_id"] | ~same["title"], "attributes_only")
        .otherwise("same")
    )
    return j.select(*results.columns, kind.alias("class")).withColumn("changed", F.col("class").isin("unknown", "restored_or_moved"))


def affiliation_rows(classified: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """The stored rows that classified results change, with their new values.

    invalid: marked deleted, nothing else; moved_to_deleted: in the closed group, without parent and title, deleted;
    restored_or_moved: the result's values, not deleted; attributes_only: the result's parent and title.
    """
    new = classified.filter(F.col("class").isin("invalid", "moved_to_deleted", "restored_or_moved", "attributes_only"))
    new = new.select(key, *[F.col(c).alias(f"n_{c}") for c in AFFILIATION], "class")
    is_ = lambda *kinds: F.col("class").isin(*kinds)
    values = {
        "group_id": F.when(is_("moved_to_deleted", "restored_or_moved"), F.col("n_group_id")).otherwise(F.col("group_id")),
        "deleted": F.when(is_("attributes_only"), F.col("deleted")).otherwise(~is_("restored_or_moved")),
    }
    for c in ("parent_id", "title"):
        values[c] = F.when(is_("restored_or_moved", "attributes_only"), F.col(f"n_{c}")).when(is_("invalid"), F.col(c))
    j = stored.join(new, key)
    return j.select(*[values[c].cast(stored.schema[c].dataType).alias(c) if c in values else F.col(c) for c in stored.columns])


def unknown_parents(results: DataFrame, parents: DataFrame, parent: str = "parent_id", closed_group: int | None = None) -> DataFrame:
    """The parents that results name and nothing stores.

    With closed_group, results are classified ones: those that the source refuses, and those of stored entities that are
    in the closed group, name none.
    """
    if closed_group is not None:
        closed = F.coalesce(F.col("group_id") == closed_group, F.lit(False))
        results = results.filter(F.col("valid") & ((F.col("class") == "unknown") | ~closed))
    return results.filter(F.col(parent).isNotNull()).select(parent).distinct().join(parents, parent, "left_anti")


def _stale(ids: DataFrame, key: str, queue: DataFrame, kind: str, before) -> DataFrame:
    """(key) of the ids that the queue has no entry for, or whose entry was never refreshed or before a time."""
    asked = ids.select(F.lit(kind).alias("kind"), F.col(key).alias("entity_id"))
    return worth_queueing(asked, queue, before).select(F.col("entity_id").alias(key))


def membership_diff(listed: DataFrame, stored: DataFrame, group: str, member: str, queue: DataFrame, kind: str, stale_before) -> DataFrame:
    """(group, member, change) per group: joined, left, unknown and active (the same, but stale by the queue).

    listed, stored: (group, member); queue: entries of the work queue, in which members are of the given kind. A member
    of another stored group joined; one that isn't stored is unknown; one stored in a listed group but not listed there
    left, and isn't written. Active ones have no entry or were not refreshed since stale_before.
    """
    own = stored.select(member, F.col(group).alias("stored_group"), F.lit(True).alias("there"))
    groups = listed.select(group).distinct()
    here = listed.select(group, member).distinct().join(own, member, "left")
    change = F.when(F.col("there").isNull(), "unknown").when(~F.col("stored_group").eqNullSafe(F.col(group)), "joined")
    here = here.select(group, member, change.alias("change"))
    same = here.filter("change IS NULL").select(group, member)
    active = same.join(_stale(same, member, queue, kind, stale_before), member, "left_semi").select(group, member, F.lit("active").alias("change"))
    gone = stored.join(groups, group, "left_semi").select(group, member).join(listed, [group, member], "left_anti")
    return here.filter("change IS NOT NULL").unionByName(active).unionByName(gone.withColumn("change", F.lit("left")))


def group_diff(live: DataFrame, stored: DataFrame, key: str, queue: DataFrame, kind: str, stale_before) -> DataFrame:
    """(key, change): closed if stored live and no longer listed, new if not stored, active if stored and stale by the queue.

    A listed group that is stored as deleted is known, so it is active if stale and never new.
    """
    a = live.select(key).distinct().withColumn("live", F.lit(True))
    b = stored.select(key, "deleted", F.lit(True).alias("there"))
    change = F.when(F.col("there").isNull(), "new").when(F.col("live").isNull() & ~F.col("deleted"), "closed")
    both = a.join(b, key, "full_outer").select(key, "live", change.alias("change"))
    known = both.filter("live AND change IS NULL").select(key)
    active = _stale(known, key, queue, kind, stale_before).withColumn("change", F.lit("active"))
    return both.filter("change IS NOT NULL").select(key, "change").unionByName(active)


def mark_deleted(df: DataFrame, ids: DataFrame, key: str, observed_at) -> DataFrame:
    """df with the given ids marked deleted, as an upsert."""
    gone = df.join(ids.select(key).distinct(), key, "left_semi").withColumn("deleted", F.lit(True)).withColumn("observed_at", F.lit(observed_at).cast("timestamp"))
    return upsert_newer(df, gone, [key])


def expand_members(top: DataFrame, groups: DataFrame, members: DataFrame, top_key: str, group_key: str, member_key: str, listed: DataFrame | None = None) -> DataFrame:
    """(kind, id) of a focus set: the top ids, their groups (stored and listed), and those groups' members."""
    own = groups.join(top.select(top_key).distinct(), top_key, "left_semi").select(group_key)
    if listed is not None:
        own = own.unionByName(listed.join(top.select(top_key).distinct(), top_key, "left_semi").select(group_key))
    own = own.distinct()
    inside = members.join(own, group_key, "left_semi").select(member_key).distinct()
    parts = [(top.select(top_key).distinct(), top_key, "top"), (own, group_key, "group"), (inside, member_key, "member")]
    out = None
    for df, key, kind in parts:
        part = df.select(F.lit(kind).alias("kind"), F.col(key).cast("long").alias("id"))
        out = part if out is None else out.unionByName(part)
    return out


def resolve_names(names: DataFrame, table: DataFrame, key: str, name: str = "name") -> DataFrame:
    """(name, id, matched): exact matches, and the names that matched nothing in either case; blank ones are dropped."""
    asked = names.select(F.trim(name).alias("asked")).filter("asked <> ''").distinct()
    found = asked.join(table.select(F.col(name).alias("asked"), F.col(key).alias("id")), "asked")
    hit = found.select(F.lower("asked").alias("low")).distinct()
    missed = asked.withColumn("low", F.lower("asked")).join(hit, "low", "left_anti").select("asked", F.lit(None).cast("long").alias("id"))
    return found.withColumn("matched", F.lit(True)).unionByName(missed.withColumn("matched", F.lit(False))).withColumnRenamed("asked", "name")


def choose_snapshots(objects: DataFrame, which: str, imported: DataFrame | None = None) -> DataFrame:
    """Snapshots by logical date: 'latest', 'all' that aren't imported yet, or an ISO day."""
    if which == "latest":
        last = objects.agg(F.max("logical_date").alias("logical_date"))
        return objects.join(F.broadcast(last), "logical_date", "left_semi")  # one row
    if which == "all":
        return objects.join(imported.select("logical_date").distinct(), "logical_date", "left_anti") if imported is not None else objects
    return objects.filter(F.col("logical_date") == F.lit(which).cast("date"))


def recheck_candidates(df: DataFrame, key: str, phase: str, closed_group: int, cursor=None, n: int = 1000) -> DataFrame:
    """A page of ids to check again: live entities, or (phase deleted) deleted ones held in the group of closed ones."""
    if phase == "live":
        return id_page(df, key, live_only=True, after=cursor, limit=n)
    return id_page(df.filter("deleted"), key, where={"group_id": closed_group}, after=cursor, limit=n)
