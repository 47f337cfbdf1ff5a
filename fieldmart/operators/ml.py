"""Machine-learning operators on ``pyspark.ml``.

Splits are deterministic key hashes (no driver-side sampling). Metrics are
DataFrame aggregates; ROC-AUC uses the distributed position helper, so the
score order is never gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.functions import exact
from fieldmart.functions.expressions import abs_error, key_hash
from fieldmart.operators import forest
from fieldmart.operators.positions import POS, counted_order
from fieldmart.session import materialize

SEED = 42
#: The deepest trees that Spark ML grows; min_leaf ends most branches earlier.
MAX_DEPTH = 30
#: Scored cells that are broadcast (some 50 MB); more are joined as Spark decides.
SMALL_CELLS = 1 << 19
#: Bits of a key hash, and those that number the ranges in which a split's end is looked for.
HASH_BITS, RANGE_BITS = 32, 12


def _total_hash(*key: str):
    """Key hash that is defined for NULL key parts too."""
    return key_hash(*[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key])


def hash_split(df: DataFrame, key: Sequence[str], test_pct: int = 25, out: str = "is_test") -> DataFrame:
    """M2: is_test = 1 when the key hash falls in the first ``test_pct`` of
    100 buckets; a missing key part counts as an empty text, so every row is in
    one part. Deterministic and re-computable after an executor loss."""
    return df.withColumn(out, (F.pmod(_total_hash(*key), F.lit(100)) < test_pct).cast("int"))


def stratified_split(df: DataFrame, key: Sequence[str], label: str, test_frac: float = 0.25, out: str = "is_test") -> DataFrame:
    """M3 (exact form): inside each label, rows ordered by key hash; the first
    ceil(frac * n_label) are test rows, so every class keeps its ratio. Rows are
    counted by (label, key): rows that repeat a key share one position, hence
    one part, and are never multiplied. A row without a label is a train row.

    No row moves: the counts by label and range of hashes say in which range the test
    part ends, that range's keys alone are put in order, and the last test key, one row a
    label, decides about every row."""
    texts = {c for c, kind in df.dtypes if kind == "string"}
    own = [F.coalesce(F.col(c), F.lit("")) if c in texts else F.col(c) for c in key]     # equal texts, equal hashes: one key
    names = ["_h", *[f"_o{i}" for i in range(len(key))]]
    place = F.struct(*[c.alias(n) for c, n in zip([_total_hash(*key), *own], names, strict=True)])
    rows = df.where(F.col(label).isNotNull()).select(F.col(label).alias("_label"), place.alias("_place"))
    rows = rows.withColumn("_range", F.shiftright("_place._h", HASH_BITS - RANGE_BITS))
    by_label = Window.partitionBy("_label")
    earlier = by_label.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_label", "_range").agg(F.count(F.lit(1)).alias("_c")).select(
        "_label", "_range", F.coalesce(F.sum("_c").over(earlier), F.lit(0)).alias("_before"),
        F.ceil(F.lit(test_frac) * F.sum("_c").over(by_label)).alias("_tests"))
    ends = sizes.where(F.col("_before") < F.col("_tests")).groupBy("_label").agg(F.max(F.struct("_range", "_before", "_tests")).alias("_end"))
    ends = materialize(ends.select("_label", "_end.*"), "split-ranges")
    counts = rows.join(ends, ["_label", "_range"]).groupBy("_label", "_before", "_tests", *[F.col(f"_place.{n}").alias(n) for n in names]).agg(F.count(F.lit(1)).alias("_c"))
    placed = counted_order(counts, ["_label"], names, "_c")
    last = placed.where(F.col("_before") + F.col(POS) < F.col("_tests")).groupBy("_label").agg(F.max(F.struct(*names)).alias("_last"))
    last = materialize(last, "split-ends")
    joined = df.join(last, df[label] == last["_label"], "left")
    return joined.select(*[df[c] for c in df.columns], F.coalesce((place <= last["_last"]).cast("int"), F.lit(0)).alias(out))


def class_weights(df: DataFrame, label: str, out: str = "w") -> DataFrame:
    """M7: balanced weight n / (k * n_c) per class. One ``groupBy(label)`` holds
    all three numbers; the windows run over its one row per class."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    every = Window.partitionBy(F.lit(1))
    return counts.select(label, "n_c", (F.sum("n_c").over(every) / (F.count(F.lit(1)).over(every) * F.col("n_c"))).alias(out))


def regression_metrics(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """MAE and RMSE (optionally per model) from exact sums."""
    e = abs_error(y, p)
    m = exact.aggregate(df, list(by), means={"mae": e, "mse": F.pow(e, 2)}, rows="rows_count")
    return m.select(*by, "mae", F.sqrt("mse").alias("rmse"), "rows_count")


def accuracy(df: DataFrame, y: str, pred: str, rows: str | None = None) -> DataFrame:
    """M12, with the row count beside it if ``rows`` names a column for it."""
    more = [F.count(F.lit(1)).alias(rows)] if rows else []
    return df.agg(F.avg((F.col(y) == F.col(pred)).cast("double")).alias("accuracy"), *more)


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """M13 (Mann-Whitney form): AUC = (sum of positive mid-ranks - P(P+1)/2)
    / (P * N). Rows are counted by score first; a score's mid-rank follows from
    the rows before it and its own. NULL when a class is missing."""
    base = df.where(F.col(y).isNotNull() & F.col(score).isNotNull())
    counts = base.groupBy(F.col(score).cast("double").alias("_s")).agg(F.sum(F.col(y).cast("int")).alias("_p"), F.count(F.lit(1)).alias("_c"))
    placed = counted_order(counts, [], ["_s"], "_c")
    mid = F.col(POS) + (F.col("_c") + 1) / 2
    tot = placed.agg(F.sum(mid * F.col("_p")).alias("_r"), F.sum("_p").alias("_P"), F.sum("_c").alias("_T"))
    neg = F.col("_T") - F.col("_P")
    auc = F.when((F.col("_P") > 0) & (neg > 0),
                 (F.col("_r") - F.col("_P") * (F.col("_P") + 1) / 2) / (F.col("_P") * neg))
    return tot.select(auc.alias("roc_auc"))


def assemble(features: Sequence[str], out: str = "features") -> VectorAssembler:
    """A missing feature is an error: callers drop such rows (P8) in plain sight."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly to one task per core. Spark ML reads its rows again for every
    level of a forest, in the tasks it gets them in: a small written table is a few
    uneven files. No more tasks than cores, because each sends the statistics of all nodes."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def fit_linear(df: DataFrame, features: Sequence[str], target: str) -> PipelineModel:
    """M4: least squares with intercept, no penalty (normal equations)."""
    lr = LinearRegression(featuresCol="features", labelCol=target, predictionCol="prediction",
                          solver="normal", regParam=0.0, fitIntercept=True)
    return Pipeline(stages=[assemble(features), lr]).fit(df)


def fit_forest_regressor(df: DataFrame, features: Sequence[str], target: str,
                         num_trees: int = 80, min_leaf: int = 3, max_depth: int = MAX_DEPTH) -> PipelineModel:
    """M5: random-forest regressor (80 trees, min leaf 3, seed 42)."""
    rf = RandomForestRegressor(featuresCol="features", labelCol=target, predictionCol="prediction",
                               numTrees=num_trees, minInstancesPerNode=min_leaf, seed=SEED,
                               featureSubsetStrategy="all", maxDepth=max_depth)
    return Pipeline(stages=[assemble(features), rf]).fit(spread(df))


def fit_forest_classifier(df: DataFrame, features: Sequence[str], label: str, weight: str | None = "w",
                          num_trees: int = 100, min_leaf: int = 3, max_depth: int = MAX_DEPTH) -> PipelineModel:
    """M6: random-forest classifier (100 trees, min leaf 3, seed 42, balanced class
    weights through ``weightCol``). The rows are counted by cell (:mod:`forest`) and the
    trees grow on the cells; where there are more of these than a task should hold, Spark
    ML grows the forest level by level over the rows."""
    kw = {"weightCol": weight} if weight else {}
    rf = RandomForestClassifier(featuresCol="features", labelCol=label, predictionCol="prediction",
                                probabilityCol="probability", numTrees=num_trees, minInstancesPerNode=min_leaf,
                                seed=SEED, featureSubsetStrategy="sqrt", maxDepth=max_depth, **kw)
    buckets = forest.bucketizer(df, features)
    cells = forest.count_cells(df, buckets, label, weight)
    if 0 < cells.count() <= forest.MOST_CELLS:
        return PipelineModel([buckets, assemble(buckets.getOutputCols()), forest.fit(cells, buckets, rf)])
    return Pipeline(stages=[assemble(features), rf]).fit(spread(df))


def fit_tree(df: DataFrame, features: Sequence[str], target: str, classes: bool, weight: str | None = None, min_leaf: int = 3,
             max_depth: int = MAX_DEPTH) -> PipelineModel:
    """One tree of the forests of M5 and M6 on all rows and all features, without
    resampling; its scores say which leaf (``leaf``) a row falls into."""
    kind, extra = (RandomForestClassifier, {"weightCol": weight} if weight else {}) if classes else (RandomForestRegressor, {})
    tree = kind(featuresCol="features", labelCol=target, predictionCol="prediction", leafCol="_leaf", numTrees=1, bootstrap=False, subsamplingRate=1.0,
                featureSubsetStrategy="all", minInstancesPerNode=min_leaf, maxDepth=max_depth, seed=SEED, **extra)
    return Pipeline(stages=[assemble(features), tree]).fit(spread(df))


def leaf_table(model: PipelineModel, df: DataFrame, target: str, weight: str | None = None) -> DataFrame:
    """Rows of ``df`` with the tree's ``leaf`` and its answer ``told`` (a prediction, or
    the probability of class 1), beside what the leaf's rows say themselves: their
    weighted mean target ``leaf_mean`` and their number ``leaf_rows``."""
    scored = model.transform(df)
    told = vector_to_array("probability")[1] if "probability" in scored.columns else F.col("prediction")
    rows = scored.select(*df.columns, vector_to_array("_leaf")[0].cast("int").alias("leaf"), told.alias("told"))
    w = F.col(weight) if weight else F.lit(1.0)
    stats = exact.aggregate(rows, ["leaf"], sums={"_t": F.col(target) * w, "_w": w}, rows="leaf_rows")
    return rows.join(stats.select("leaf", (F.col("_t") / F.col("_w")).alias("leaf_mean"), "leaf_rows"), "leaf")


def score(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """M8: score every row (train rows included, T18)."""
    scored = model.transform(spread(df))
    keep = [c for c in df.columns] + ["prediction"]
    res = scored.select(*keep)
    return res.withColumnRenamed("prediction", out) if out != "prediction" else res


def risk_score(model: PipelineModel, df: DataFrame, out: str = "risk_score") -> DataFrame:
    """M9: probability of class 1 for every row. A forest on cells scores each cell once;
    the rows take the score of theirs."""
    told = [vector_to_array("probability")[1].alias(out), F.col("prediction").cast("int").alias("predicted_label")]
    if not isinstance(model.stages[0], Bucketizer):
        return model.transform(spread(df)).select(*df.columns, *told)
    bins = model.stages[0].getOutputCols()

    def binned(rows: DataFrame) -> DataFrame:
        return model.stages[0].transform(rows).withColumns({c: F.col(c).cast("byte") for c in bins})

    cells = spread(binned(df).select(*bins).distinct())
    scored = materialize(PipelineModel(model.stages[1:]).transform(cells).select(*bins, *told), "scored-cells")
    if scored.count() <= SMALL_CELLS:
        scored = F.broadcast(scored)
    rows = df if df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism else spread(df)
    return binned(rows).join(scored, bins).select(*df.columns, out, "predicted_label")
