"""Progress from samples of cumulative counters: (series, at, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _seconds(c):
    return F.unix_micros(c.cast("timestamp")) / 1e6


def counter_rates(samples: DataFrame, series: list[str], at: str = "at", value: str = "value") -> DataFrame:
    """samples with the change since the one before (never negative), the window, and rates a minute and a day.

    A window of no length has no rate; the first sample of a series has none either.
    """
    w = Window.partitionBy(*series).orderBy(at, value)
    change = F.col(value) - F.lag(value).over(w)
    delta = F.when(change.isNotNull(), F.greatest(change, F.lit(0)))
    window = _seconds(F.col(at)) - _seconds(F.lag(at).over(w))
    out = samples.withColumn("delta", delta).withColumn("window_s", window)
    per = F.when(F.col("window_s") > 0, F.col("delta") / F.col("window_s"))
    return out.withColumn("per_minute", F.round(per * 60, 6)).withColumn("per_day", F.round(per * 86400, 4))


def budget_outlook(rates: DataFrame, budget: int, at: str = "at", used: str = "value") -> DataFrame:
    """rates with spent_at: when a day's budget is spent at the rate, and whether it lasts the day."""
    left = F.greatest(F.lit(budget) - F.col(used), F.lit(0))
    midnight = F.date_add(F.to_date(at), 1).cast("timestamp")
    hours = F.when(F.col("per_minute") > 0, left / F.col("per_minute") / 60)
    spent = F.timestamp_seconds(F.floor(_seconds(F.col(at)) + hours * 3600))
    out = rates.withColumn("spent_at", F.when(hours.isNotNull(), spent))
    return out.withColumn("lasts_the_day", F.coalesce(F.col("spent_at") >= midnight, F.lit(True)))


def cycle_progress(samples: DataFrame, series: list[str], total: str, done: str = "value", at: str = "at") -> DataFrame:
    """samples with state and minutes_left, an upper bound: finished, not started, restarted in the window, or running."""
    w = Window.partitionBy(*series).orderBy(at)
    before, since = F.lag(done).over(w), _seconds(F.col(at)) - _seconds(F.lag(at).over(w))
    out = samples.withColumn("__before", before).withColumn("__since", since)
    state = F.when(F.col(done) >= F.col(total), "finished").when(F.col(done) == 0, "not started").when(F.col(done) < F.col("__before"), "restarted").otherwise("running")
    rate = (F.col(done) - F.col("__before")) / F.col("__since")
    left = F.when((F.col("state") == "running") & (rate > 0), F.ceil((F.col(total) - F.col(done)) / rate / 60))
    return out.withColumn("state", state).withColumn("minutes_left", left).drop("__before", "__since")


def queue_rates(samples: DataFrame, at: str = "at", size: str = "value", cls: str = "priority") -> DataFrame:
    """samples with change_per_minute of each class's queue size."""
    w = Window.partitionBy(cls).orderBy(at)
    window = _seconds(F.col(at)) - _seconds(F.lag(at).over(w))
    return samples.withColumn("change_per_minute", F.round((F.col(size) - F.lag(size).over(w)) / window * 60, 6))
