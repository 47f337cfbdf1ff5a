"""Statistics kept from run to run against the one-go forms; places in an order."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fieldmart import session
from fieldmart.operators import clean, history, marts, positions, ranking


def facts(spark, seed, n, days):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        flow = rnd.choice([None, float("nan"), 0.0, -0.0, 1e-12, -3.5, 1e9, float(rnd.randrange(40)), rnd.gauss(10, 3)])
        rows.append((rnd.choice([1, 1, 1, 2, 3, None]), dt.date(2026, 1, 1 + rnd.randrange(days)), flow, rnd.choice([None, rnd.random()]), rnd.choice([None, 1.0, 5.0]), rnd.uniform(-2, 30)))
    rows += [(7, dt.date(2026, 1, 1), None, None, None, 1.0), (8, dt.date(2026, 1, 1), 4.0, None, 2.0, 1.0)]
    return spark.createDataFrame(rows, "entity_id long, day date, flow double, oil double, water double, downtime double").withColumn(
        "flow", F.nanvl("flow", F.lit(None).cast("double")))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def test_stored_quantiles_equal_ranked_ones(spark, tmp_root):
    a, b = facts(spark, 1, 700, 5), facts(spark, 2, 300, 5)
    history.add_counts(a, "entity_id", ["flow", "water"], f"{tmp_root}/c", "a")
    history.add_counts(a.limit(10), "entity_id", ["flow", "water"], f"{tmp_root}/c", "b")   # replaced below
    history.add_counts(b, "entity_id", ["flow", "water"], f"{tmp_root}/c", "b")
    counts, probs = history.read_counts(spark, f"{tmp_root}/c"), {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}
    both = a.unionByName(b)
    want = positions.quantiles(both, ["entity_id"], ["flow", "water"], probs)
    got = history.stored_quantiles(counts, "entity_id", ["flow", "water"], probs)
    assert rows_of(got.select(*want.columns)) == rows_of(want)


def test_few_values_are_ranked(spark, tmp_root):
    """Only the buckets that hold the asked positions are ranked."""
    df = spark.range(20_000).select((F.col("id") % 2).alias("e"), (F.rand(3) * 1000).alias("x"))
    counts = history.value_counts(df, "e", ["x"])
    seen = []
    real = history.counted_order
    history.counted_order = lambda few, *a, **k: seen.append(few.count()) or real(few, *a, **k)
    try:
        history.stored_quantiles(counts, "e", ["x"], {"m": 0.5}).collect()
    finally:
        history.counted_order = real
    assert 0 < seen[0] < 2_000


def test_cleaning_with_a_later_part_equals_one_go(spark, tmp_root):
    a, b = facts(spark, 3, 500, 4), facts(spark, 4, 200, 6)
    for part, df in (("a", a), ("b", b)):
        history.add_counts(df, "entity_id", ["water", "flow"], f"{tmp_root}/c", part)
    both = a.unionByName(b)
    got = history.clean_daily_fact(both, history.read_counts(spark, f"{tmp_root}/c"))
    assert rows_of(got) == rows_of(clean.clean_daily_fact(both))


@pytest.mark.parametrize("rewrite", [True, False])
def test_marts_from_states_equal_a_rebuild(spark, tmp_root, rewrite):
    df = facts(spark, 5, 600, 6)
    measures, late = ["flow", "oil", "downtime"], F.col("day") == "2026-01-04"
    first = df.withColumn("flow", F.when(late, F.col("flow") * 2).otherwise(F.col("flow"))) if rewrite else df.where(~late)
    history.add_daily_states(first, "entity_id", "day", measures, tmp_root, "s")
    manifest = history.add_daily_states(df.where(late), "entity_id", "day", measures, tmp_root, "s")
    assert {r.partition_value for r in manifest.collect()} == {"2026-01-04"}
    states = history.daily_states(spark, tmp_root, "s")
    known = df.where(F.col("entity_id").isNotNull())
    assert rows_of(history.production_daily(states)) == rows_of(marts.production_daily(known))
    assert rows_of(history.entity_kpi(states)) == rows_of(marts.entity_kpi(known))
    daily = known.withColumn("ts", F.col("day").cast("timestamp_ntz"))
    assert rows_of(history.readings_daily(states, {"m": "flow"}, {"s": "oil"})) == rows_of(marts.readings_daily(daily, means={"m": "flow"}, sums={"s": "oil"}))


def test_places(spark):
    rnd = random.Random(8)
    rows = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, 0.5, 1.5]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b double, id int").repartition(7)
    got = {r.id: r.place for r in ranking.placed(df, ["-a", "b", "id"]).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is None, r[1] or 0, r[2]))
    assert got == {r[2]: i + 1 for i, r in enumerate(order)}
    assert ranking.placed(df.where("false"), ["a"]).collect() == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_states_are_not_shuffled(spark, tmp_root, monkeypatch):
    """The narrow rows are dealt once, over more ranges than a shuffle's where a task
    would hold too many of them."""
    seen, real = [], history.write_dates
    monkeypatch.setattr(history, "write_dates", lambda states, *a, **k: seen.append(states) or real(states, *a, **k))
    monkeypatch.setattr(session, "ROWS_A_TASK", 20)
    df = facts(spark, 6, 900, 6)
    history.add_daily_states(df, "entity_id", "day", ["flow", "oil"], tmp_root, "s")
    plan = plan_of(seen[0])
    assert plan.count("Exchange") == 1 and "Exchange rangepartitioning" in plan
    assert seen[0].rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    states = history.daily_states(spark, tmp_root, "s")
    keys = ["entity_id", "day", "_b_flow", "_b_oil"]
    assert states.groupBy(*keys).count().where("count > 1").isEmpty()
    daily = df.where("entity_id is not null").withColumn("ts", F.col("day").cast("timestamp_ntz"))
    assert rows_of(history.readings_daily(states, {"m": "flow"}, {"s": "oil"})) == rows_of(marts.readings_daily(daily, means={"m": "flow"}, sums={"s": "oil"}))


def test_no_states_of_no_rows(spark, tmp_root):
    assert history.add_daily_states(facts(spark, 6, 9, 3).where("false"), "entity_id", "day", ["flow"], tmp_root, "s").isEmpty()
