"""L5 anomaly and failure-risk job: W3/P11 -> J5 -> M3/M7/M6 -> M9 ->
M15/M16 and the metrics row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.operators import anomaly, joins, ml
from fieldmart.session import materialize

LABEL = "failure_within_7d"


def add_zscores_and_labels(sensors: DataFrame, failures: DataFrame, sensor_cols: Sequence[str],
                           key: str = "entity_id", ts: str = "ts", failure_time: str = "failure_time",
                           horizon_days: int = 7) -> DataFrame:
    z = anomaly.flag_anomalies(anomaly.group_zscore(sensors, key, sensor_cols), sensor_cols)
    return joins.label_within(z, failures, key, ts, failure_time, horizon_days, out=LABEL)


def train_failure_model(df: DataFrame, sensor_cols: Sequence[str], row_key: Sequence[str],
                        max_depth: int = ml.MAX_DEPTH) -> tuple[DataFrame, DataFrame]:
    """Stratified split, balanced weights, forest,
    risk for every row (T18), test accuracy and ROC-AUC."""
    feats = [*sensor_cols, *[f"z_{c}" for c in sensor_cols], "is_anomaly"]
    model_df = materialize(df.dropna(subset=[*feats, LABEL]), "risk_rows")   # read twice by the split
    split = materialize(ml.stratified_split(model_df, row_key, LABEL), "risk_split")   # read by fit, scoring, counts
    train = split.where(F.col("is_test") == 0)
    weights = ml.class_weights(train, LABEL)
    train_w = train.join(F.broadcast(weights.select(LABEL, "w")), LABEL, "left")  # one row per class
    model = ml.fit_forest_classifier(train_w, feats, LABEL, weight="w", max_depth=max_depth)
    risk = materialize(ml.risk_score(model, split), "risk")   # scored once: outputs, metrics and counts read it
    test = risk.where(F.col("is_test") == 1)
    acc = ml.accuracy(test, LABEL, "predicted_label")
    auc = ml.roc_auc(test, LABEL, "risk_score")
    n = split.agg(F.count_if(F.col("is_test") == 0).alias("train"), F.count_if(F.col("is_test") == 1).alias("test")).first()
    n_train, n_test = n["train"], n["test"]
    metrics = (acc.select(F.lit("random_forest_classifier").alias("model_name"), "accuracy",
                          auc.select("roc_auc").scalar().alias("roc_auc"))
                  .withColumn("rows_train", F.lit(n_train)).withColumn("rows_test", F.lit(n_test)))
    return risk, metrics


def risk_outputs(risk: DataFrame, key: str = "entity_id", ts: str = "ts",
                 sensor_cols: Sequence[str] = (), extra: Sequence[str] = ()) -> dict[str, DataFrame]:
    """M15 (anomalous rows: key, extra ids, time, sensors, flags, risk) and
    M16 (every row: key, extra ids, time, risk, label, flag)."""
    anomalies = risk.where(F.col("is_anomaly") == 1).select(
        key, *extra, ts, *sensor_cols, "is_anomaly", LABEL, "risk_score")
    risk_rows = risk.select(key, *extra, ts, "risk_score", LABEL, "is_anomaly")
    return {"mart_pump_anomalies": anomalies.withColumn("event_date", F.to_date(ts)),
            "mart_pump_risk": risk_rows.withColumn("event_date", F.to_date(ts))}
