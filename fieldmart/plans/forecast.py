"""L4 flow forecast: M1 dataset -> M2 split -> M4/M5 fits -> M14 choice ->
M8 scoring -> metrics table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.functions.expressions import abs_error
from fieldmart.operators import joins, marts, ml
from fieldmart.operators.setops import union_all
from fieldmart.session import materialize

TARGET = "actual_flow_rate_tpd"
#: The compared models, in their order.
MODELS = ("linear_regression", "random_forest")


def flow_dataset(targets: DataFrame, readings: DataFrame, features_means: dict, features_sums: dict,
                 key: str = "entity_id", day: str = "day", ts: str = "ts") -> DataFrame:
    """M1 (A4 + J4 + P8): daily means/sums of the *raw* readings (T19) inner
    joined to the targets on (entity, day); rows with a missing feature or
    target are dropped."""
    per_day = marts.readings_daily(readings, key=key, ts=ts, day=day, means=features_means, sums=features_sums)
    ds = joins.daily_join(targets, per_day, [key, day], "inner")
    return ds.dropna(subset=[*features_means, *features_sums, TARGET])


def train_and_predict(dataset: DataFrame, features: Sequence[str], key: Sequence[str],
                      target: str = TARGET, max_depth: int = ml.MAX_DEPTH, *,
                      models: Sequence[str] = MODELS) -> tuple[DataFrame, DataFrame]:
    """Fit the models on the hash-split train part,
    pick the smallest test RMSE (the first wins a tie), score every row."""
    # Written once: both fits, both scorings and the row counts read it.
    split = materialize(ml.hash_split(dataset, key), "flow_split")
    train = split.where(F.col("is_test") == 0)
    test = split.where(F.col("is_test") == 1)
    fits = {"linear_regression": ml.fit_linear, "random_forest": partial(ml.fit_forest_regressor, max_depth=max_depth)}
    rows_train = train.count()
    rows_test = test.count()
    metric_frames, fitted = [], {}
    for order, name in enumerate(models):
        model = fits[name](train, features, target)
        fitted[name] = model
        pred = ml.score(model, test, out="_pred")
        metric_frames.append(ml.regression_metrics(pred, target, "_pred").select(
            F.lit(name).alias("model_name"), F.lit(order).alias("model_order"), "mae", "rmse"))
    metrics = union_all(*metric_frames)
    metrics = (metrics.withColumn("rows_train", F.lit(rows_train)).withColumn("rows_test", F.lit(rows_test))
                      .withColumn("created_at", F.current_timestamp()))
    best_name = metrics.orderBy(F.col("rmse").asc_nulls_last(), "model_order").first()["model_name"]
    predictions = (ml.score(fitted[best_name], split, out="predicted_flow_rate_tpd")
                     .withColumn("absolute_error", abs_error(target, "predicted_flow_rate_tpd"))
                     .withColumn("model_name", F.lit(best_name)))
    return predictions, metrics.orderBy("rmse", "model_order").drop("model_order")
