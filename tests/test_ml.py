"""ML properties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldmart.operators import ml


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(3)
    n = 800
    a, b = rng.normal(size=n), rng.normal(size=n)
    y = 3 * a - 2 * b + 5 + rng.normal(scale=0.1, size=n)
    pdf = pd.DataFrame({"id": np.arange(n), "a": a, "b": b, "y": y})
    return spark.createDataFrame(pdf)


def test_linear_residuals_orthogonal(planted):
    model = ml.fit_linear(planted, ["a", "b"], "y")
    s = ml.score(model, planted, out="p").withColumn("e", F.col("y") - F.col("p")).toPandas()
    assert abs(s.e.sum()) < 1e-6
    assert abs((s.e * s.a).sum()) < 1e-6 and abs((s.e * s.b).sum()) < 1e-6


def test_forest_beats_std_and_is_reproducible(planted):
    m1 = ml.fit_forest_regressor(planted, ["a", "b"], "y", num_trees=10)
    p1 = ml.score(m1, planted, out="p")
    rmse = ml.regression_metrics(p1, "y", "p").first().rmse
    assert rmse < planted.agg(F.stddev("y")).first()[0]
    m2 = ml.fit_forest_regressor(planted, ["a", "b"], "y", num_trees=10)
    p2 = ml.score(m2, planted, out="p")
    assert p1.orderBy("id").select("p").collect() == p2.orderBy("id").select("p").collect()


def test_auc_matches_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = np.random.default_rng(5)
    n = 500
    y = (rng.random(n) < 0.3).astype(int)
    s = np.round(y * 0.3 + rng.random(n), 2)       # ties
    df = spark.createDataFrame(pd.DataFrame({"y": y.astype(float), "s": s}))
    ours = ml.roc_auc(df, "y", "s").first().roc_auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="s", labelCol="y", numBins=0).evaluate(df)
    assert ours == pytest.approx(ev, abs=1e-9)


def test_auc_null_for_one_class(spark):
    df = spark.createDataFrame([(1.0, 0.2), (1.0, 0.4)], "y double, s double")
    assert ml.roc_auc(df, "y", "s").first().roc_auc is None


def test_stratified_split_keeps_ratio(spark):
    df = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(1000)], "id long, label int")
    out = ml.stratified_split(df, ["id"], "label").groupBy("label").agg(F.sum("is_test").alias("t"),
                                                                         F.count("*").alias("n"))
    got = {r.label: (r.t, r.n) for r in out.collect()}
    assert got[1] == (25, 100) and got[0] == (225, 900)


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    w = {r.label: r.w for r in ml.class_weights(df, "label").collect()}
    assert w[0] == pytest.approx(8 / (2 * 6)) and w[1] == pytest.approx(8 / (2 * 2))


def test_forests_train_and_score_in_even_tasks(spark, monkeypatch):
    """A table of one uneven file gives every core its share of the rows."""
    from pyspark.ml import Pipeline

    rows = spark.range(400).selectExpr("id", "cast(id % 7 as double) as x", "cast(id % 7 > 3 as int) as label").coalesce(1)
    seen, fit = [], Pipeline.fit
    monkeypatch.setattr(Pipeline, "fit", lambda self, df, *a: seen.append(df) or fit(self, df, *a))
    model = ml.fit_forest_classifier(rows, ["x"], "label", weight=None, num_trees=2, max_depth=3)
    flow = ml.fit_forest_regressor(rows, ["x"], "label", num_trees=2, max_depth=3)
    tasks = spark.sparkContext.defaultParallelism
    for df in (*seen, ml.risk_score(model, rows), ml.score(flow, rows)):
        sizes = [n for _, n in df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()]
        assert sum(sizes) == 400 and len(sizes) == tasks and max(sizes) <= 400 // tasks + 1


def test_stratified_split_leaves_rows_in_place(spark, tmp_path, capsys):
    """The parts follow from one key a label: the rows' own plan shuffles nothing, and
    the parts are those of the whole order, repeated and missing keys included."""
    import hashlib

    rng = np.random.default_rng(11)
    ids = [None if i % 40 == 0 else int(i) for i in rng.integers(0, 900, 3000)]
    labels = [int(y) for y in rng.integers(0, 3, 3000)]
    spark.createDataFrame(list(zip(ids, labels)), "id long, label int").write.parquet(f"{tmp_path}/rows")
    out = ml.stratified_split(spark.read.parquet(f"{tmp_path}/rows"), ["id"], "label")
    out.explain()
    plan = capsys.readouterr().out
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan and "BroadcastHashJoin" in plan
    got = {(r.id, r.label): r.is_test for r in out.distinct().collect()}
    for y in range(3):
        own = ["" if i is None else str(i) for i, label in zip(ids, labels) if label == y]
        at, tests = 0, -(-len(own) // 4)
        for k in sorted(set(own), key=lambda k: (int(hashlib.md5(k.encode()).hexdigest()[:8], 16), int(k or -1))):
            assert got[(int(k) if k else None, y)] == int(at < tests)
            at += own.count(k)
    assert out.count() == 3000
