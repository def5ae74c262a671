"""Named reads and progress rates over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import progress
from ._register import registry
from .inputs import LINES_SQL, history, numbered_lines, table
from .named import run_named, top_groups

query, QUERIES, ORACLES = registry()
BETWEEN = {"date_from": "1996-03-01", "date_to": "1996-04-15"}
DAYS = "DATE '1996-03-01' AND DATE '1996-04-15'"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"), F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("region_id"), F.col("o_totalprice").alias("total"))


def _lines(spark, sf_dir):
    lines = numbered_lines(spark, sf_dir)
    o = _orders(spark, sf_dir).select("day", "id")
    return o.join(lines, F.col("id") == F.col("l_orderkey")).select("day", "id", F.when(F.col("rn") % 3 != 1, F.expr("cast((rn + 2) div 3 AS int)")).alias("parent_ordinal"), F.col("rn").alias("ordinal"), F.col("l_partkey").alias("part"))


@query(f"SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey AS id, o_custkey AS region_id, o_totalprice AS total FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN {DAYS}")
def q_header_by_date(spark, sf_dir):
    _orders(spark, sf_dir).createOrReplaceTempView("headers")
    return run_named(spark, "header_by_date", BETWEEN)


_LINES = f"WITH {LINES_SQL} SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey AS id, CASE WHEN rn % 3 <> 1 THEN CAST((rn + 2) // 3 AS INT) END AS parent_ordinal, CAST(rn AS INT) AS ordinal, l_partkey AS part FROM orders JOIN l ON l_orderkey = o_orderkey WHERE CAST(o_orderdate AS DATE) BETWEEN {DAYS}"


@query(_LINES)
def q_child_by_date(spark, sf_dir):
    _lines(spark, sf_dir).createOrReplaceTempView("children")
    return run_named(spark, "child_by_date", BETWEEN)


@query(_LINES)
def q_items_by_date(spark, sf_dir):
    _lines(spark, sf_dir).createOrReplaceTempView("items")
    return run_named(spark, "items_by_date", BETWEEN)


@query(f"SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey AS id, o_custkey AS region_id, o_totalprice AS total FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1995-01-01' AND DATE '2001-12-31' AND o_custkey = 5")
def q_optional_filter(spark, sf_dir):
    _orders(spark, sf_dir).createOrReplaceTempView("market")
    return run_named(spark, "market_by_date", {"date_from": "1995-01-01", "date_to": "2001-12-31", "region_id": "5"})


@query("SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_custkey IN (3, 5, 900)")
def q_by_id(spark, sf_dir):
    table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).createOrReplaceTempView("members")
    return run_named(spark, "members_by_id", {"ids": "5,3,5,900,123456789"})


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_suppkey IN (1, 2)")
def q_by_id_supplier(spark, sf_dir):
    table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")).createOrReplaceTempView("groups")
    return run_named(spark, "groups_by_id", {"ids": "2,1"})


@query("SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation WHERE n_nationkey IN (7, 9)")
def q_by_id_nation(spark, sf_dir):
    table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name")).createOrReplaceTempView("parents")
    return run_named(spark, "parents_by_id", {"ids": "7,9"})


@query("SELECT o_custkey AS id, o_orderkey AS record_id FROM orders WHERE o_custkey IN (11, 12)")
def q_history_by_id(spark, sf_dir):
    history(spark, sf_dir).select("id", "record_id").createOrReplaceTempView("history")
    return run_named(spark, "history_by_id", {"ids": "11,12"})


@query("SELECT l_suppkey AS id, l_orderkey * 10 + l_linenumber AS record_id FROM lineitem WHERE l_suppkey IN (4)")
def q_history_by_id2(spark, sf_dir):
    table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("record_id")).createOrReplaceTempView("group_history")
    return run_named(spark, "group_history_by_id", {"ids": "4"})


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS n_rows FROM events GROUP BY 1 ORDER BY n_rows DESC, user_id LIMIT 10")
def top_users(spark, sf_dir):
    return top_groups(table(spark, sf_dir, "events"), "user_id")


def _samples(spark, sf_dir):
    """Cumulative events of each type by hour; the counter starts anew each day."""
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events")
    hours = e.groupBy("event_type", F.date_trunc("HOUR", "ts").alias("hour")).agg(F.count("*").alias("n"))
    day = Window.partitionBy("event_type", F.to_date("hour")).orderBy("hour").rowsBetween(Window.unboundedPreceding, 0)
    return hours.select("event_type", "hour", F.sum("n").over(day).alias("value"))


_SAMPLES = """hours AS (SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY ALL),
samples AS (SELECT event_type, hour, CAST(sum(n) OVER (PARTITION BY event_type, CAST(hour AS DATE) ORDER BY hour ROWS UNBOUNDED PRECEDING) AS BIGINT) AS value FROM hours),
r AS (SELECT *, greatest(value - lag(value) OVER w, 0) AS delta0, lag(value) OVER w AS before, epoch(hour) - epoch(lag(hour) OVER w) AS window_s FROM samples WINDOW w AS (PARTITION BY event_type ORDER BY hour)),
rates AS (SELECT event_type, hour, value, before, CASE WHEN window_s IS NOT NULL THEN delta0 END AS delta, window_s FROM r)"""
_AT = "strftime(hour, '%Y-%m-%d %H:%M:%S') AS hour"


def _at():
    return F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour")


@query(f"WITH {_SAMPLES} SELECT event_type, {_AT}, value, round(delta / window_s * 60, 6) AS per_minute, round(delta / window_s * 86400, 4) AS per_day FROM rates")
def counter_rates(spark, sf_dir):
    return progress.counter_rates(_samples(spark, sf_dir), ["event_type"], at="hour").select("event_type", _at(), "value", "per_minute", "per_day")


@query(f"""WITH {_SAMPLES}, p AS (SELECT *, round(delta / window_s * 60, 6) AS pm FROM rates), s AS (SELECT *, CASE WHEN pm > 0 THEN floor(epoch(hour) + greatest(60 - value, 0) / pm / 60 * 3600) END AS spent FROM p)
SELECT event_type, {_AT}, coalesce(spent >= epoch(CAST(hour AS DATE) + 1), true) AS lasts_the_day FROM s""")
def budget_outlook(spark, sf_dir):
    rates = progress.counter_rates(_samples(spark, sf_dir), ["event_type"], at="hour")
    return progress.budget_outlook(rates, 60, at="hour").select("event_type", _at(), "lasts_the_day")


@query(f"""WITH {_SAMPLES}, st AS (SELECT *, CASE WHEN value >= 80 THEN 'finished' WHEN value = 0 THEN 'not started' WHEN value < before THEN 'restarted' ELSE 'running' END AS state, (value - before) / window_s AS rate FROM rates)
SELECT event_type, {_AT}, state, CASE WHEN state = 'running' AND rate > 0 THEN CAST(ceil((80 - value) / rate / 60) AS BIGINT) END AS minutes_left FROM st""")
def cycle_progress(spark, sf_dir):
    s = _samples(spark, sf_dir).withColumn("total", F.lit(80))
    return progress.cycle_progress(s, ["event_type"], "total", at="hour").select("event_type", _at(), "state", "minutes_left")


@query(f"WITH {_SAMPLES} SELECT event_type, {_AT}, round((value - before) / window_s * 60, 6) AS change_per_minute FROM rates")
def queue_rates(spark, sf_dir):
    return progress.queue_rates(_samples(spark, sf_dir), at="hour", cls="event_type").select("event_type", _at(), "change_per_minute")
