"""The forest on cells: the whole forest, whatever the number of rows."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from fieldmart.operators import forest, ml


@pytest.fixture(scope="module")
def noisy(spark):
    """Four features of many values and a flag; a label that follows two of them."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 4))
    flag = (x[:, 0] > 1.5).astype(int)
    label = (x[:, 0] * x[:, 1] + rng.normal(scale=0.5, size=3000) > 0.3).astype(int)
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(id=np.arange(3000), flag=flag, label=label, w=np.where(label == 1, 1.5, 0.7))
    return spark.createDataFrame(pdf).repartition(3)


FEATURES = ["a", "b", "c", "d", "flag"]


def test_spark_ml_sees_cells_not_rows(spark, monkeypatch):
    """Rows that fall into few cells are counted once: no forest passes over the rows."""
    rows = spark.range(6000).selectExpr("id", "cast(id % 7 as double) as x", "cast(id % 5 as double) as y", "cast(id % 7 > 3 as int) as label")
    seen, fit, transform = [], Pipeline.fit, PipelineModel._transform
    monkeypatch.setattr(Pipeline, "fit", lambda self, df, *a: seen.append(df) or fit(self, df, *a))
    monkeypatch.setattr(PipelineModel, "_transform", lambda self, df: seen.append(df) or transform(self, df))
    model = ml.fit_forest_classifier(rows, ["x", "y"], "label", weight=None, num_trees=3, max_depth=4)
    scored = ml.risk_score(model, rows)
    assert [df.count() for df in seen] == [35]
    assert scored.count() == 6000 and scored.columns == [*rows.columns, "risk_score", "predicted_label"]
    wrong = scored.where((F.col("label") != F.col("predicted_label")) | ~F.col("risk_score").between(0, 1))
    assert wrong.count() == 0


def test_rows_score_as_the_model_scores_them(noisy, monkeypatch):
    model = ml.fit_forest_classifier(noisy, FEATURES, "label", num_trees=20, max_depth=8)
    own = {r.id: (r.risk_score, r.predicted_label) for r in ml.risk_score(model, noisy).collect()}
    direct = model.transform(noisy).select("id", "probability", "prediction").collect()
    assert len(own) == 3000 and all(own[r.id] == (r.probability[1], int(r.prediction)) for r in direct)
    monkeypatch.setattr(ml, "SMALL_CELLS", 0)             # no broadcast
    assert own == {r.id: (r.risk_score, r.predicted_label) for r in ml.risk_score(model, noisy).collect()}


def test_forest_is_as_good_as_spark_ml_grows_it(noisy, monkeypatch):
    train, test = noisy.where("id % 4 > 0"), noisy.where("id % 4 = 0")
    ours = ml.fit_forest_classifier(train, FEATURES, "label", num_trees=60, max_depth=10)
    monkeypatch.setattr(forest, "MOST_CELLS", 1)          # more cells than that: Spark ML grows it
    theirs = ml.fit_forest_classifier(train, FEATURES, "label", num_trees=60, max_depth=10)
    assert isinstance(theirs.stages[-1], type(ours.stages[-1])) and len(theirs.stages) == 2 and len(ours.stages) == 3
    a, b = (ml.risk_score(m, test).orderBy("id").toPandas() for m in (ours, theirs))
    auc = [ml.roc_auc(test.sparkSession.createDataFrame(x[["label", "risk_score"]]), "label", "risk_score").first().roc_auc for x in (a, b)]
    assert auc[0] > 0.8 and abs(auc[0] - auc[1]) < 0.03
    assert np.corrcoef(a.risk_score, b.risk_score)[0, 1] > 0.95 and abs(a.risk_score.mean() - b.risk_score.mean()) < 0.03


def test_trees_keep_their_rules(noisy):
    """100 trees by default settings of M6: depth, min leaf and every drawn row."""
    model = ml.fit_forest_classifier(noisy, FEATURES, "label", num_trees=7, max_depth=6)
    rf = model.stages[-1]
    assert rf.getNumTrees == 7 and rf.numClasses == 2 and rf.numFeatures == 5
    assert [p for p in (rf.getMaxDepth(), rf.getOrDefault("minInstancesPerNode"), rf.getSeed())] == [6, 3, ml.SEED]
    assert max(t.depth for t in rf.trees) == 6 and len({t.toDebugString for t in rf.trees}) == 7
    buckets = model.stages[0]
    held = forest.gathered(forest.count_cells(noisy, buckets, "label", "w"), buckets)
    assert held["rows"].sum() == 3000 and (held["weight"] * held["rows"]).sum() == pytest.approx(noisy.agg(F.sum("w")).first()[0])
    for t in range(3):
        tree = forest.grow(held, [ml.SEED, t], 2, 32, 3, 30)
        inner = tree["left"] >= 0
        left, right = tree["left"][inner], tree["right"][inner]
        assert (tree["raw"] >= 3).all() and np.array_equal(tree["raw"][inner], tree["raw"][left] + tree["raw"][right])
        assert np.allclose(tree["stats"][inner], tree["stats"][left] + tree["stats"][right])
        assert tree["raw"][0] == np.random.default_rng([ml.SEED, t]).poisson(held["rows"]).sum()
        assert 2800 < tree["raw"][0] < 3200 and (left > np.flatnonzero(inner)).all()
        assert sorted([*left, *right]) == list(range(1, len(inner)))


def test_best_split_is_the_best_of_all():
    rng = np.random.default_rng(2)
    n, n_bins, classes = 400, 6, 3
    bins, label, node = rng.integers(0, n_bins, (n, 3)).astype(np.uint8), rng.integers(0, classes, n).astype(np.uint8), np.sort(rng.integers(0, 5, n))
    drawn = rng.integers(1, 4, n)
    weight = drawn * rng.random(n)
    stats = np.stack([np.bincount(label[node == v], weights=weight[node == v], minlength=classes) for v in range(5)])
    raw = np.bincount(node, weights=drawn)
    own = np.array([[0, 1], [1, 2], [2, 0], [0, 2], [1, 0]])
    gain, feature, bin_, left_stats, left_raw = forest.best_splits(bins, node, label, weight, drawn, stats, raw, own, n_bins, 10)

    def impurity(rows):
        w = np.array([weight[rows & (label == c)].sum() for c in range(classes)])
        return 1 - ((w / w.sum()) ** 2).sum(), w.sum()

    for v in range(5):
        here, best = node == v, -1.0
        for f, s in itertools.product(own[v], range(n_bins - 1)):
            left = here & (bins[:, f] <= s)
            if min(drawn[left].sum(), drawn[here & ~left].sum()) >= 10:
                (g, w), (gl, wl), (gr, wr) = impurity(here), impurity(left), impurity(here & ~left)
                best = max(best, g - wl / w * gl - wr / w * gr)
        left = here & (bins[:, feature[v]] <= bin_[v])
        assert gain[v] == pytest.approx(best) and left_raw[v] == drawn[left].sum() and left_stats[v].sum() == pytest.approx(weight[left].sum())


def test_forest_ignores_tasks_and_repeated_rows_count(noisy):
    """The same bins give the same forest from any partitions; a row that comes twice counts twice."""
    buckets = forest.bucketizer(noisy, FEATURES)
    rf = RandomForestClassifier(numTrees=5, maxDepth=5, minInstancesPerNode=3, seed=ml.SEED)
    one, many = (forest.fit(forest.count_cells(df, buckets, "label", "w"), buckets, rf).toDebugString for df in (noisy.coalesce(1), noisy.repartition(11)))
    assert one == many
    twice = forest.gathered(forest.count_cells(noisy.union(noisy), buckets, "label", "w"), buckets)
    once = forest.gathered(forest.count_cells(noisy, buckets, "label", "w"), buckets)
    assert np.array_equal(twice["rows"], 2 * once["rows"]) and np.array_equal(twice["bins"], once["bins"])


def test_bins_keep_few_values_apart_and_cut_many_evenly(spark):
    df = spark.range(5000).selectExpr("cast(id as double) as many", "cast(id = 17 as int) as rare", "cast(id % 32 as int) as all_32", "1.5 as constant",
                                      "case id when 0 then -0.0D when 1 then double('infinity') when 2 then double('-infinity') else cast(id % 3 as double) end as odd")
    buckets = forest.bucketizer(df, df.columns)
    binned = buckets.transform(df)
    for c, b in zip(buckets.getInputCols(), buckets.getOutputCols()):
        sizes = [r["count"] for r in binned.groupBy(b).count().collect()]
        if c == "many":
            assert len(sizes) == 32 and max(sizes) < 2 * 5000 / 32
        elif c != "odd":
            assert len(sizes) == df.select(c).distinct().count()
    assert binned.where("rare = 1").select(buckets.getOutputCols()[1]).distinct().count() == 1
    assert binned.groupBy(buckets.getOutputCols()[4]).count().count() >= 3


@pytest.mark.parametrize("bad", ["cast(null as double)", "double('nan')"])
def test_missing_features_and_weights_are_errors(spark, bad):
    rows = spark.range(40).selectExpr("cast(id as double) as x", "cast(id % 2 as int) as label", "1.0D as w")
    for name in ("x", "w"):
        broken = rows.withColumn(name, F.when(F.col("label") == 1, F.expr(bad)).otherwise(F.col(name)))
        with pytest.raises(Exception):
            ml.fit_forest_classifier(broken, ["x"], "label", num_trees=2, max_depth=2)
        if name == "x":
            model = ml.fit_forest_classifier(rows, ["x"], "label", num_trees=2, max_depth=2)
            with pytest.raises(Exception):
                ml.risk_score(model, broken).collect()


def test_no_failure_at_all_is_no_risk(spark):
    rows = spark.range(40).selectExpr("cast(id as double) as x", "0 as label")
    model = ml.fit_forest_classifier(rows, ["x"], "label", weight=None, num_trees=2, max_depth=2)
    assert {tuple(r) for r in ml.risk_score(model, rows).select("risk_score", "predicted_label").collect()} == {(0.0, 0)}


@pytest.mark.parametrize("name", ["failure_risk", "pump_anomalies", "sql_q8_failure_metrics"])
def test_failure_queries_keep_every_row_without_passes_over_them(spark, tmp_path, monkeypatch, name):
    """Each of the three queries scores all readings that have their features, and none
    hands the rows to Spark ML."""
    from fieldmart.plans import queries

    n = 4000
    spark.range(n).selectExpr(
        "id as event_id", "timestamp_seconds(1700000000 + id * 700) as ts", "id % 9 as user_id", "if(id % 11 = 0, 'error', 'view') as event_type",
        "if(id % 200 = 0, 900.0D, cast(20 + pmod(hash(id), 90) as double)) as value", "concat('{\"k\": ', pmod(hash(id, 1), 97), '}') as props",
    ).withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(Pipeline, "fit", lambda self, df, *a: pytest.fail("Spark ML was given the rows"))
    out = queries.QUERIES[name](spark, str(tmp_path))
    whole = n - sum(i % 97 == 0 or i % 151 == 0 for i in range(n))                # views.READ_VALUE_NULL, READ_K_NULL
    if name == "sql_q8_failure_metrics":
        m = out.first()
        assert (m.rows_train + m.rows_test, m.accuracy_ok, m.auc_ok) == (whole, 1, 1) and abs(m.rows_test - whole / 4) <= 2
        return
    spikes = sum(i % 200 == 0 and i % 97 > 0 and i % 151 > 0 for i in range(n))
    if name == "failure_risk":
        assert out.count() == whole
    assert out.where("is_anomaly = 1").count() >= spikes and out.where("risk_ok = 0 or risk_ok is null").count() == 0
