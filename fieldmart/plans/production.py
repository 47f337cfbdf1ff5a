"""L3 production marts with the L1/L2 cleaning, on any tables whose column
names are passed in (the reference's names in :mod:`fieldmart.plans.runner`,
the driver views' names in tests)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.operators import clean, marts, ranking


def build_production_marts(production: DataFrame, telemetry: DataFrame, wells: DataFrame, *,
                           key: str, day: str, ts: str, flow: str, oil: str, water: str, downtime: str,
                           measures: Sequence[str], ranges: Mapping[str, tuple[float, float]],
                           runtime: str, reading_means: Mapping[str, str], reading_sums: Mapping[str, str],
                           pressure: str, temperature: str,
                           well_columns: Mapping[str, str],
                           keep: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> dict[str, DataFrame]:
    """L3: cleaned tables, daily mart, entity KPI, ranking, features, heatmap.

    ``well_columns`` maps the dimension's name/field/region/status columns to
    the mart's names. ``keep(df, name)`` is applied to the tables that feed
    several marts (cleaned tables, KPI, features): pass
    :func:`fieldmart.session.materialize` to write them once."""
    cp = keep(clean.clean_daily_fact(production, key=key, day=day, flow=flow, oil=oil, water=water,
                                     downtime=downtime), "clean_production")
    ct = keep(clean.clean_readings(telemetry, key=key, ts=ts, measures=list(measures), ranges=ranges,
                                   clip_column=runtime, day="event_date"), "clean_telemetry")
    dims = wells.select(key, *[F.col(src).alias(dst) for src, dst in well_columns.items()])
    daily = marts.production_daily(cp, day=day, key=key, flow=flow, oil=oil, downtime=downtime)
    kpi = keep(marts.entity_kpi(cp, dims, key=key, day=day, flow=flow, oil=oil, downtime=downtime,
                                entity_columns=list(well_columns.values())), "mart_well_kpi")
    rank = ranking.rank_group(ranking.rank_desc(kpi, "avg_flow_rate_tpd"))
    per_day = marts.readings_daily(ct, key=key, ts=ts, day=day, means=reading_means, sums=reading_sums)
    feature_dims = [c for c in well_columns.values() if c in ("field_name", "region")]
    # the KPI mart holds the dimension's columns of just the entities that produce, as often as
    # the dimension does, and its size is known: the features don't move again to meet all wells
    features = keep(marts.features_daily(cp, per_day, kpi, key=key, day=day, downtime=downtime,
                                         entity_columns=feature_dims), "features_well_daily")
    heat = marts.bin_heatmap(features, pressure, temperature, flow, key=key)
    return {"clean_production": cp, "clean_telemetry": ct, "mart_production_daily": daily,
            "mart_well_kpi": kpi, "mart_well_ranking": rank, "features_well_daily": features,
            "mart_pressure_flow_heatmap": heat}
