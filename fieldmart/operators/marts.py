"""Aggregations and marts.

Sums and means are the exact ones of :mod:`fieldmart.functions.exact`, two
``groupBy().agg()`` that Spark aggregates partially on the map side, so a hot key
sends few partial rows per task. Distinct counts are an aggregate of their own, joined
on the key: pass a written table where the frame is dear to compute. Global values (row counts, min/max for bins) are scalar subqueries, never
cross joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions import exact
from fieldmart.functions.aggregates import distinct_days, nunique
from fieldmart.functions.expressions import ratio_pct, safe_div


def daily_columns(day: str) -> list[str]:
    return [day, "total_oil_tons", "avg_flow_rate_tpd", "total_downtime_hours", "active_wells"]


def production_daily(df: DataFrame, day: str = "day", key: str = "entity_id", flow: str = "flow",
                     oil: str = "oil", downtime: str = "downtime", approx_distinct: bool = False) -> DataFrame:
    """A1: per day -> total oil, mean flow, total downtime, active entities
    (entities with a row that day, whatever their status -- T21)."""
    base = df.where(F.col(day).isNotNull())
    sums = exact.aggregate(base, [day], sums={"total_oil_tons": oil, "total_downtime_hours": downtime}, means={"avg_flow_rate_tpd": flow})
    active = base.groupBy(day).agg(nunique(key, approx_distinct).alias("active_wells"))
    return sums.join(active, day).select(*daily_columns(day))


def entity_kpi(df: DataFrame, entities: DataFrame | None = None, key: str = "entity_id", day: str = "day",
               flow: str = "flow", oil: str = "oil", downtime: str = "downtime",
               entity_columns: Sequence[str] = ("name", "field", "region", "status"),
               approx_distinct: bool = False) -> DataFrame:
    """A2 + J1 + E1: per entity mean flow, total oil, total downtime, distinct
    days; dimension columns; downtime % = hours / (days * 24) * 100."""
    base = df.where(F.col(key).isNotNull())
    sums = exact.aggregate(base, [key], sums={"total_oil_tons": oil, "downtime_hours": downtime}, means={"avg_flow_rate_tpd": flow})
    if dict(base.dtypes)[day] == "date" and not approx_distinct:
        days = distinct_days(base, [key], day, "days_count")
    else:
        days = base.groupBy(key).agg(nunique(day, approx_distinct).alias("days_count"))
    return kpi_columns(sums.join(days, key), key, entities, entity_columns)


def kpi_columns(kpi: DataFrame, key: str, entities: DataFrame | None, entity_columns: Sequence[str]) -> DataFrame:
    """The KPI mart's columns from its sums, mean and day count."""
    from fieldmart.operators.joins import enrich

    kpi = kpi.select(key, "avg_flow_rate_tpd", "total_oil_tons", "downtime_hours", "days_count")
    if entities is not None:
        kpi = enrich(kpi, entities, key, list(entity_columns))
    return kpi.withColumn("downtime_pct", ratio_pct("downtime_hours", "days_count"))


def readings_daily(df: DataFrame, key: str = "entity_id", ts: str = "ts", day: str = "day",
                   means: Mapping[str, str] | None = None, sums: Mapping[str, str] | None = None) -> DataFrame:
    """A3/A4: per (entity, day) means and sums (sums of nothing are 0, T1).
    ``means``/``sums`` map output name -> input column."""
    base = df.withColumn(day, F.to_date(F.col(ts))).where(F.col(key).isNotNull() & F.col(day).isNotNull())
    return exact.aggregate(base, [key, day], sums=sums, means=means).select(key, day, *(means or {}), *(sums or {}))


def features_daily(fact: DataFrame, readings_per_day: DataFrame, entities: DataFrame | None,
                   key: str = "entity_id", day: str = "day", downtime: str = "downtime",
                   entity_columns: Sequence[str] = ("field", "region")) -> DataFrame:
    """J2 + E2 + J3: daily fact LEFT JOIN daily readings on (entity, day),
    downtime ratio = hours / 24, then the entity's field and region."""
    from fieldmart.operators.joins import daily_join, enrich

    out = daily_join(fact, readings_per_day, [key, day], "left")
    out = out.withColumn("downtime_ratio", F.col(downtime) / F.lit(24.0))
    if entities is not None:
        out = enrich(out, entities, key, list(entity_columns))
    return out


def equal_width_bins(df: DataFrame, columns: Mapping[str, str], bins: int = 6) -> DataFrame:
    """``pd.cut(x, bins)`` for each ``column -> prefix``: right-closed
    bins between the edges ``mn + j * (mx - mn) / bins``; the last edge is mx, the
    lowest is lowered by 0.1 % of the range, and if mn = mx both ends are first
    moved out by 0.1 % of |mn| (by 0.001 at 0), which puts all values into the
    middle bin, the third of six. A value's bin is the number of edges below it.
    Adds ``{prefix}_idx`` (1..bins, NULL for a missing value), ``{prefix}_lo``,
    ``{prefix}_hi`` and the label ``{prefix}`` = "(lo, hi]" with 3 decimals, or
    'nan' for a missing value. Infinite values raise an error, as there.

    All minima and maxima come from one scalar subquery, attached once as a
    struct column (one extra pass, no cross join)."""
    stats = {}
    for i, c in enumerate(columns):
        x = F.col(c).cast("double")
        stats[f"mn{i}"] = F.min(x)
        stats[f"mx{i}"] = F.max(x)
    sub = df.agg(F.struct(*[v.alias(k) for k, v in stats.items()]).alias("s")).scalar()
    out = df.withColumn("_bin_stats", sub)
    for i, (c, p) in enumerate(columns.items()):
        x = F.col(c).cast("double")
        mn, mx = F.col(f"_bin_stats.mn{i}"), F.col(f"_bin_stats.mx{i}")
        infinite = (F.abs(mn) == float("inf")) | (F.abs(mx) == float("inf"))
        pad = F.when(mn == 0, F.lit(0.001)).otherwise(F.abs(mn) * F.lit(0.001))
        low = F.when(infinite, F.raise_error(F.lit(f"{c}: infinite values can't be binned"))).when(mn == mx, mn - pad).otherwise(mn)
        out = out.withColumn("_low", low.cast("double")).withColumn("_high", F.when(mn == mx, mx + pad).otherwise(mx))
        step = (F.col("_high") - F.col("_low")) / F.lit(float(bins))
        edges = [F.col("_low") + F.lit(float(j)) * step for j in range(bins)] + [F.col("_high")]
        first = F.when(mn == mx, edges[0]).otherwise(edges[0] - (F.col("_high") - F.col("_low")) * F.lit(0.001))
        out = out.withColumn("_edges", F.array(first, *edges[1:]))
        below = F.size(F.filter("_edges", lambda e: e < x))
        out = out.withColumn(f"{p}_idx", F.when(x.isNotNull(), F.least(F.lit(bins), F.greatest(F.lit(1), below))))
        idx = F.col(f"{p}_idx")
        out = (out.withColumn(f"{p}_lo", F.get("_edges", idx - 1)).withColumn(f"{p}_hi", F.get("_edges", idx)).drop("_low", "_high", "_edges"))
        label = F.concat(F.lit("("), F.round(F.col(f"{p}_lo"), 3).cast("string"), F.lit(", "),
                         F.round(F.col(f"{p}_hi"), 3).cast("string"), F.lit("]"))
        out = out.withColumn(p, F.when(idx.isNull(), F.lit("nan")).otherwise(label))
    return out.drop("_bin_stats")


def bin_heatmap(features: DataFrame, x_col: str, y_col: str, measure: str, key: str = "entity_id",
                bins: int = 6, x_name: str = "pressure_bin", y_name: str = "temperature_bin") -> DataFrame:
    """A5: (x bin, y bin) -> mean of the measure and count of entity ids.
    Sorted by bin index, not by label text (T9)."""
    b = equal_width_bins(features.select(key, measure, x_col, y_col), {x_col: x_name, y_col: y_name}, bins)
    return exact.aggregate(b, [f"{x_name}_idx", x_name, f"{y_name}_idx", y_name], means={"avg_flow_rate_tpd": measure}, counts={"observations": key})


def dashboard_filter(df: DataFrame, day: str = "day", date_from=None, date_to=None,
                     regions: Sequence[str] | None = None, entities: Sequence | None = None,
                     region_col: str = "region", key: str = "entity_id") -> DataFrame:
    """Optional date range (inclusive), region list and entity list."""
    cond: Column = F.lit(True)
    if date_from is not None:
        cond = cond & (F.col(day) >= F.lit(date_from).cast("date"))
    if date_to is not None:
        cond = cond & (F.col(day) <= F.lit(date_to).cast("date"))
    if regions:
        cond = cond & F.col(region_col).isin(list(regions))
    if entities:
        cond = cond & F.col(key).isin(list(entities))
    return df.where(cond)


def kpi_cards(features: DataFrame, oil: str = "oil", flow: str = "flow", pressure: str = "avg_value",
              downtime: str = "downtime") -> DataFrame:
    """A10: one row -- total production, mean flow, mean pressure, downtime %
    (downtime hours over 24 h per (entity, day) row)."""
    cards = exact.aggregate(features, sums={"total_oil_tons": oil, "downtime": downtime}, means={"avg_flow_rate_tpd": flow, "avg_pressure_atm": pressure}, rows="rows_count")
    pct = safe_div("downtime", F.col("rows_count") * F.lit(24.0)) * F.lit(100.0)
    return cards.select("total_oil_tons", "avg_flow_rate_tpd", "avg_pressure_atm", pct.alias("downtime_pct"), "rows_count")


def downtime_summary(kpi: DataFrame, by: str = "region") -> DataFrame:
    """Downtime analysis from the entity KPI mart, per region."""
    found = exact.aggregate(kpi.where(F.col(by).isNotNull()), [by], sums={"downtime_hours": "downtime_hours", "days_count": "days_count"}, rows="wells")
    return found.select(by, "downtime_hours", F.col("days_count").cast("bigint").alias("days_count"), "wells",
                        ratio_pct("downtime_hours", "days_count").alias("downtime_pct"))
