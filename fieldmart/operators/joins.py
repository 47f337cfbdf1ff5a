"""Joins.

* J1/J3 ``enrich``: fact LEFT JOIN dimension. The dimension is broadcast only
  when Spark's size check (file statistics, or AQE's measured shuffle size)
  puts it under the broadcast threshold; otherwise a shuffle join.
* J2/J4: equi-joins on (entity, day); both sides are per-day aggregates, so
  they are already hash-partitioned on the entity when AQE keeps the
  aggregation's partitioning.
* J5 ``label_within``: a reading is labelled 1 when a failure of the same
  entity happens in [t, t + horizon]. Failure intervals [f - horizon, f] are
  first reduced per (entity, day) and merged per entity (gaps and islands),
  so they are disjoint; each
  merged interval is copied to every day it covers, and readings join on
  (entity, day) with the interval test. A reading lies in at most one merged
  interval, so the left join never duplicates a reading, and each
  (entity, day) key has at most two intervals -- the number of join partners
  is bounded without any cap.
* J6 ``entity_calendar``: the expected (entity, day) grid from each entity's
  own first to last day (``explode(sequence)``), no cross join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Dates that an expected-days grid may span.
CALENDAR = ("1970-01-01", "2099-12-31")

def enrich(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Left join selected dimension columns on ``key`` (N:1).

    No hint is given: Spark broadcasts the dimension when its size is below
    ``autoBroadcastJoinThreshold`` -- from file statistics at planning time, or
    from the measured shuffle output under AQE -- and otherwise plans a shuffle
    join (with skew splitting of the fact side)."""
    return fact.join(dim.select(key, *columns), key, "left")


def daily_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """J2 (left) / J4 (inner) on (entity, day)."""
    return left.join(right, list(keys), how)


def merge_failure_intervals(failures: DataFrame, key: str, time_col: str, horizon_days: int) -> DataFrame:
    """Union of the closed intervals [f - horizon, f] per entity as disjoint
    (key, start, end) rows.

    Failures are first reduced to one row per (entity, day): with a horizon
    of at least one day, all intervals ending on the same day overlap, so
    their union is [min f - horizon, max f]. The gaps-and-islands window then
    sees at most one row per entity and calendar day, however many failures
    an entity has. Two consecutive day-rows belong to one island iff the later
    start is not after the earlier end."""
    if horizon_days < 1:
        raise ValueError("horizon_days must be at least 1")
    horizon = F.make_dt_interval(F.lit(horizon_days))
    per_day = (failures.select(F.col(key).alias("_k"), F.col(time_col).alias("_f"))
                       .where(F.col("_k").isNotNull() & F.col("_f").isNotNull())
                       .groupBy("_k", F.to_date("_f").alias("_d"))
                       .agg(F.min("_f").alias("_lo"), F.max("_f").alias("_hi")))
    w = Window.partitionBy("_k").orderBy("_d")
    prev_end = F.lag("_hi").over(w)
    starts = per_day.withColumn("_new", F.when(prev_end.isNull() | (F.col("_lo") - horizon > prev_end), 1).otherwise(0))
    islands = starts.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (islands.groupBy("_k", "_island")
                   .agg((F.min("_lo") - horizon).alias("_start"), F.max("_hi").alias("_end"))
                   .select(F.col("_k").alias(key), "_start", "_end"))


def label_within(readings: DataFrame, failures: DataFrame, key: str, time_col: str,
                 failure_time_col: str, horizon_days: int = 7, out: str = "failure_within_7d") -> DataFrame:
    """1 if the same entity fails in [t, t + horizon] (both ends
    inclusive), else 0. Keeps every reading exactly once."""
    iv = merge_failure_intervals(failures, key, failure_time_col, horizon_days)
    by_day = iv.select(key, "_start", "_end",
                       F.explode(F.sequence(F.to_date("_start"), F.to_date("_end"))).alias("_day"))
    r = readings.withColumn("_day", F.to_date(F.col(time_col)))
    cond = ((r[key] == by_day[key]) & (r["_day"] == by_day["_day"])
            & (r[time_col] >= by_day["_start"]) & (r[time_col] <= by_day["_end"]))
    joined = r.join(by_day, cond, "left")
    return joined.select(*[r[c] for c in readings.columns],
                         F.when(by_day["_start"].isNotNull(), 1).otherwise(0).alias(out))


def out_of_range_days(fact: DataFrame, key: str, day: str, first: str = CALENDAR[0], last: str = CALENDAR[1]) -> DataFrame:
    """Fact rows (key, day) whose date lies outside the calendar, for reports."""
    d = F.to_date(day)
    return fact.where((d < F.lit(first).cast("date")) | (d > F.lit(last).cast("date"))).select(key, d.alias(day))


def entity_calendar(fact: DataFrame, key: str, day: str, first: str | None = CALENDAR[0], last: str | None = CALENDAR[1]) -> DataFrame:
    """Every (entity, day) between the entity's first and last day. Dates
    outside [first, last] (sentinels such as year 9999) don't stretch a span;
    :func:`out_of_range_days` lists them. A bound of None is no bound."""
    if first is not None:
        fact = fact.where(F.to_date(day) >= F.lit(first).cast("date"))
    if last is not None:
        fact = fact.where(F.to_date(day) <= F.lit(last).cast("date"))
    span = fact.groupBy(key).agg(F.min(F.to_date(day)).alias("_lo"), F.max(F.to_date(day)).alias("_hi"))
    return span.select(key, F.explode(F.sequence("_lo", "_hi")).alias(day))


def missing_days(fact: DataFrame, key: str, day: str, first: str | None = CALENDAR[0], last: str | None = CALENDAR[1]) -> DataFrame:
    """C4: (entity, day) cells of the expected grid with no fact row; the bounds
    are those of :func:`entity_calendar`."""
    have = fact.select(key, F.to_date(day).alias(day)).where(F.col(key).isNotNull())
    return entity_calendar(have, key, day, first, last).join(have, [key, day], "left_anti")
