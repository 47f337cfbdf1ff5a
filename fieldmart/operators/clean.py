"""Per-entity cleaning.

Group statistics come from :mod:`fieldmart.operators.positions`, which never
holds a whole entity in one task, and are joined back on the entity key: AQE
broadcasts the per-entity table when it is small once measured and splits a hot
entity's partition of the fact side otherwise. Rows without an entity don't
take part in that join."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions.expressions import clip, fill_from, in_range, round6
from fieldmart.operators.positions import ordered_statistics, present, quantiles
from fieldmart.session import materialize


def fill_group_median(df: DataFrame, key: str, columns: Sequence[str], medians: DataFrame | None = None) -> DataFrame:
    """A missing value takes the median of its entity; an entity whose
    values are all missing stays missing; a row without an entity is left as
    it is (pandas drops missing group keys). ``medians`` may be given (key and
    ``_med_<column>``), as :mod:`fieldmart.operators.history` keeps them. They are written,
    one row per entity, so that the join knows their size before it moves the rows."""
    med = materialize(quantiles(df, [key], columns, {"_med": 0.5}) if medians is None else medians, "entity-medians")
    out = df.where(F.col(key).isNotNull()).join(med, key, "left")
    filled = out.select(*[_filled(c) if c in columns else F.col(c) for c in df.columns])
    return filled.unionByName(df.where(F.col(key).isNull()).withColumns({c: F.col(c).cast("double") for c in columns}))


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column).cast("double"), F.col(f"_med_{column}")).alias(column)


def _bounds(column: str, k: float = 1.5) -> list[Column]:
    """W2's bounds from an entity's quartiles, worked out once per entity."""
    q1, q3 = F.col(f"_q1_{column}"), F.col(f"_q3_{column}")
    iqr = q3 - q1
    return [(round6(iqr) == 0).alias(f"_flat_{column}"), round6(q1 - F.lit(k) * iqr).alias(f"_low_{column}"), round6(q3 + F.lit(k) * iqr).alias(f"_high_{column}")]


def _inside(column: str) -> Column:
    """W2's test of a row that has its entity's bounds beside it."""
    x = round6(F.col(column).cast("double"))
    return F.coalesce(F.col(f"_flat_{column}") | ((x >= F.col(f"_low_{column}")) & (x <= F.col(f"_high_{column}"))), F.lit(False))


def drop_iqr_outliers(df: DataFrame, key: str, column: str, k: float = 1.5, fences: DataFrame | None = None) -> DataFrame:
    """Keep rows inside [q1 - k*iqr, q3 + k*iqr] of their entity.
    iqr = 0 keeps the whole entity; a missing value, an entity with no values
    or a missing entity fails the test, as in the pandas group filter. Fences and
    values are compared at 6 decimals, so the last bits of an interpolation or a
    mean don't decide about a row on the fence."""
    q = quantiles(df, [key], [column], {"_q1": 0.25, "_q3": 0.75}) if fences is None else fences
    out = df.where(F.col(key).isNotNull()).join(q.select(key, *_bounds(column, k)), key, "left")
    return out.where(_inside(column)).select(*df.columns)


def range_filter(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """P5: inclusive range conditions combined with AND; missing values fail."""
    cond = F.lit(True)
    for c, (lo, hi) in ranges.items():
        cond = cond & in_range(c, lo, hi)
    return df.where(cond)


def clean_daily_fact(df: DataFrame, key: str = "entity_id", day: str = "day",
                     flow: str = "flow", oil: str = "oil", water: str = "water",
                     downtime: str = "downtime", oil_factor: float = 0.9,
                     clip_range: tuple[float, float] = (0.0, 24.0),
                     medians: DataFrame | None = None, fences: DataFrame | None = None) -> DataFrame:
    """L1 (clean_production): day to date -> median fill of water and flow ->
    IQR fences on flow -> clip downtime -> oil falls back to flow * 0.9.
    The order is fixed (T20): medians change the quantiles, fences run before
    the fallback. Medians and fences are written as one table of a row per entity and
    joined once; a row without an entity fails the fences (W2)."""
    out = df.withColumn(day, F.to_date(F.col(day)))
    if medians is None or fences is None:
        out, medians, fences = ordered_statistics(out, key, [water, flow], flow, {"_q1": 0.25, "_q3": 0.75})
    stats = medians.join(fences, key, "full").select(key, f"_med_{water}", f"_med_{flow}", *_bounds(flow))
    stats = materialize(stats, "entity-statistics")
    out = present(out, [key]).join(stats, key, "left")
    out = out.select(*[_filled(c) if c in (water, flow) else F.col(c) for c in df.columns], *[f"_{b}_{flow}" for b in ("flat", "low", "high")])
    out = out.where(_inside(flow)).select(*df.columns)
    out = out.withColumn(downtime, clip(F.col(downtime).cast("double"), *clip_range))
    out = out.withColumn(oil, fill_from(F.col(oil).cast("double"), F.col(flow) * F.lit(oil_factor)))
    return out


def clean_readings(df: DataFrame, key: str = "entity_id", ts: str = "ts",
                   measures: Sequence[str] = ("value", "k", "runtime"),
                   ranges: Mapping[str, tuple[float, float]] | None = None,
                   clip_column: str | None = "runtime", clip_range: tuple[float, float] = (0.0, 24.0),
                   day: str = "day", medians: DataFrame | None = None) -> DataFrame:
    """L2 (clean_telemetry): median fill of every measure -> inclusive range
    filter -> clip one column -> add the reading's date."""
    out = fill_group_median(df, key, list(measures), medians)
    if ranges:
        out = range_filter(out, ranges)
    if clip_column:
        out = out.withColumn(clip_column, clip(F.col(clip_column), *clip_range))
    return out.withColumn(day, F.to_date(F.col(ts)))
