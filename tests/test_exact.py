"""Exact sums: values, order of rows, merged states; moments and distinct counts."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from fieldmart.functions import aggregates, exact
from fieldmart.operators import anomaly, ml

INF = float("inf")


def both(spark, values, parts=2):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    r = exact.aggregate(df, sums={"s": "x"}, means={"m": "x"}, counts={"c": "x"}, rows="n").first()
    return r["s"], r["m"], r["c"], r["n"]


@pytest.mark.parametrize("values, want", [
    ([1e-10, 3e-10], (4e-10, 2e-10, 2, 2)),
    ([INF, 1.0], (INF, INF, 2, 2)),
    ([-INF, 1.0, None], (-INF, -INF, 2, 3)),
    ([INF, -INF], (None, None, 2, 2)),
    ([1e300, 1e300, -1e300], (1e300, 1e300 / 3, 3, 3)),
    ([1e29, 1.0, -1e29], (1.0, 1 / 3, 3, 3)),
    ([5e-324, 5e-324], (1e-323, 5e-324, 2, 2)),
    ([1.7e308, 1.7e308], (INF, INF, 2, 2)),
    ([1 / 3] * 3, (1.0, 1 / 3, 3, 3)),
    ([float("nan"), 2.0], (2.0, 2.0, 2, 2)),
    ([None, None], (0.0, None, 0, 2)),
    ([], (0.0, None, 0, 0)),
    ([-0.0, 0.0], (0.0, 0.0, 2, 2)),
    ([-1e-5, 2.0 ** 28, -2.0 ** 28], (-1e-5, -1e-5 / 3, 3, 3)),
])
def test_values(spark, values, want):
    assert both(spark, values) == want


def some_values(rnd, kind, n):
    if kind == "plain":
        return [rnd.uniform(-1000, 1000) for _ in range(n)]
    if kind == "wide":
        return [math.ldexp(rnd.uniform(-1, 1), rnd.randrange(-1070, 1000)) for _ in range(n)]
    return [rnd.gauss(0, 1) * 10.0 ** rnd.randrange(-12, 12) for _ in range(n)]


@pytest.mark.parametrize("kind", ["plain", "wide", "mixed"])
def test_order_and_partitions_do_not_show(spark, kind):
    rnd = random.Random(kind)
    values, seen = some_values(rnd, kind, 500), set()
    for parts in (1, 8, 64):
        rnd.shuffle(values)
        seen.add(both(spark, values, parts))
    (total, _, _, _), = seen
    true = sum(Fraction(v) for v in values)
    assert abs(Fraction(total) - true) <= 3 * Fraction(math.ulp(float(true)))


def test_states_merge_like_one_pass(spark):
    """States of parts, merged in any order, equal the state of the whole table."""
    rnd = random.Random(5)
    rows = [(i % 3, a, b) for i, (a, b) in enumerate(zip(some_values(rnd, "mixed", 600), some_values(rnd, "wide", 600)))]
    df = spark.createDataFrame(rows, "k long, a double, b double")
    measures = {"a": "a", "b": "b"}
    parts = [exact.states(df.where(F.col("a") * 7 % 1 < 0.5), ["k"], measures), exact.states(df.where(F.col("a") * 7 % 1 >= 0.5), ["k"], measures)]
    whole = exact.finish(exact.states(df, ["k"], measures), ["k"], {"a": "a"}, {"b": "b"}, rows="n").orderBy("k").collect()
    for order in (parts, parts[::-1]):
        assert exact.finish(exact.merge(order, ["k"], ["a", "b"]), ["k"], {"a": "a"}, {"b": "b"}, rows="n").orderBy("k").collect() == whole


def test_one_shuffle_of_partial_sums(spark):
    """Groups are combined before the first shuffle, and no Python runs."""
    plan = exact.aggregate(spark.range(10).select((F.col("id") % 2).alias("k"), F.rand(1).alias("x")), ["k"], sums={"s": "x"})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Python" not in plan and "partial_sum" in plan


def test_moments_do_not_depend_on_partitions(spark):
    rnd = random.Random(2)
    rows = [(i % 4, 1e6 + rnd.gauss(0, 1e-3), rnd.gauss(5, 2) if i % 5 else None) for i in range(800)] + [(9, 1.0, None), (None, 3.0, 4.0)]
    got = []
    for parts in (1, 8, 64):
        df = spark.createDataFrame(rows, "e long, x double, y double").repartition(parts)
        z = anomaly.group_zscore(df, "e", ["x", "y"])
        m = ml.regression_metrics(df.dropna(), "x", "y").first()
        got.append((sorted(map(tuple, z.select("x", "z_x", "z_y").collect())), tuple(m)))
    assert got[0] == got[1] == got[2]
    xs = [x for e, x, _ in rows if e == 1]
    mu = float(sum(map(Fraction, xs)) / len(xs))
    sd = math.sqrt(sum((x - mu) ** 2 for x in xs) / (len(xs) - 1))
    by_x = {x: z for x, z, _ in got[0][0]}
    assert all(by_x[x] == pytest.approx((x - mu) / sd, rel=1e-9) for x in xs)
    assert by_x[1.0] == 0.0 and by_x[3.0] == 0.0


def test_distinct_counts_merge(spark):
    df = spark.range(3000).select((F.col("id") % 7).alias("k"), (F.col("id") * 7919 % 100_000 - 5000).alias("v"),
                                  F.expr("date'1969-12-01' + cast(id % 400 as int)").alias("day"))
    for c in ("v", "day"):
        parts = [aggregates.distinct_states(df.where(cond), ["k"], c) for cond in ("id % 2 = 0", "id % 3 = 0", "true")]
        got = aggregates.distinct_counts(aggregates.merge_distinct(parts, ["k"]), ["k"], "n").orderBy("k").collect()
        assert got == df.groupBy("k").agg(F.countDistinct(c).alias("n")).orderBy("k").collect()
    with pytest.raises(ValueError):
        aggregates.distinct_states(df.withColumn("v", F.lit("a")), ["k"], "v")


def test_names(spark):
    df = spark.createDataFrame([("a", 1.5), ("a", 2.0), (None, 1.0)], "`the key` string, `a value` double")
    got = exact.aggregate(df, ["the key"], sums={"total": "`a value`"}, means={"mean of it": "`a value`"}, rows="n")
    assert got.columns == ["the key", "total", "mean of it", "n"]
    assert {tuple(r) for r in got.collect()} == {("a", 3.5, 1.75, 2), (None, 1.0, 1.0, 1)}
    with pytest.raises(ValueError):
        exact.states(df, ["the key"], {"a value": "`a value`"})
