"""Per-entity z-scores and anomaly flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.functions import exact
from fieldmart.functions.expressions import any_abs_over


def group_moments(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Mean ``_mu_c`` and sample standard deviation ``_sd_c`` (ddof = 1, NULL for
    fewer than two values) of each column per entity, whatever the order of rows: exact
    sums give the means, exact sums of squared distances to them the deviations."""
    rows = df.where(F.col(key).isNotNull()).select(key, *[F.col(c).cast("double").alias(c) for c in columns])
    means = exact.aggregate(rows, [key], means={f"_mu_{c}": c for c in columns})
    apart = rows.join(means, key).select(key, *[F.pow(F.col(c) - F.col(f"_mu_{c}"), 2).alias(c) for c in columns])
    squares = exact.aggregate(apart, [key], sums={f"_ss_{c}": c for c in columns}, counts={f"_n_{c}": c for c in columns})
    deviations = [F.sqrt(F.try_divide(F.col(f"_ss_{c}"), F.col(f"_n_{c}") - 1)).alias(f"_sd_{c}") for c in columns]
    return means.join(squares.select(key, *deviations), key)


def group_zscore(df: DataFrame, key: str, columns: Sequence[str], prefix: str = "z_") -> DataFrame:
    """z = (x - mean) / std per entity (sample std). std 0 or missing,
    missing x, or a missing entity -> z = 0 (T2, T7). Means and stds come from
    partially aggregated sums joined back on the key, so no row order shows."""
    out = df.join(group_moments(df, key, columns), key, "left")
    for c in columns:
        z = F.try_divide(F.col(c) - F.col(f"_mu_{c}"), F.nullif(F.col(f"_sd_{c}"), F.lit(0.0)))
        out = out.withColumn(f"{prefix}{c}", F.coalesce(z, F.lit(0.0)))
    return out.drop(*[f"_mu_{c}" for c in columns], *[f"_sd_{c}" for c in columns])


def flag_anomalies(df: DataFrame, columns: Sequence[str], prefix: str = "z_", limit: float = 3.0,
                   out: str = "is_anomaly") -> DataFrame:
    """1 if any |z| > limit."""
    return df.withColumn(out, any_abs_over([f"{prefix}{c}" for c in columns], limit))
