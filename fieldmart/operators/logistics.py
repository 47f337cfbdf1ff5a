"""Delivery KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.functions import exact
from fieldmart.functions.aggregates import rows
from fieldmart.functions.expressions import safe_div, threshold_flag
from fieldmart.operators.ranking import rank_asc


def enrich_deliveries(df: DataFrame, cost: str = "cost", distance: str = "distance",
                      delay: str = "delay", delay_limit: float = 2.0) -> DataFrame:
    """E3 + P10: cost per km (NULL for a zero distance, T6) and the delay flag."""
    return (df.withColumn("cost_per_km", safe_div(F.col(cost), F.col(distance)))
              .withColumn("is_delayed", threshold_flag(delay, delay_limit)))


def delay_by_category(df: DataFrame, category: str = "category", delay: str = "delay") -> DataFrame:
    """Per weather/category -> mean delay, delayed share, deliveries."""
    return exact.aggregate(df.where(F.col(category).isNotNull()), [category],
                           means={"avg_delay_hours": delay, "delayed_share": "is_delayed"}, rows="deliveries_count")


def cost_by_route(df: DataFrame, route: str = "route", distance: str = "distance", cost: str = "cost") -> DataFrame:
    """Per route -> mean distance, mean cost, mean of per-row cost/km
    (not a ratio of sums), deliveries."""
    return exact.aggregate(df.where(F.col(route).isNotNull()), [route],
                           means={"avg_distance_km": distance, "avg_cost_rub": cost, "avg_cost_per_km": "cost_per_km"}, rows="deliveries_count")


def bad_distance(df: DataFrame, route: str = "route", distance: str = "distance") -> DataFrame:
    """Per route, deliveries whose distance is missing or zero (their cost
    per km is NULL), beside all deliveries."""
    return (df.where(F.col(route).isNotNull()).groupBy(route).agg(
        F.count_if(F.col(distance).isNull() | (F.col(distance) == 0)).alias("bad_distance"), rows().alias("deliveries_count")))


def driver_kpi(df: DataFrame, driver: str = "driver_id", delay: str = "delay", volume: str = "volume") -> DataFrame:
    """Per driver -> mean delay, delayed share, mean cost/km, total
    volume, deliveries."""
    found = exact.aggregate(df.where(F.col(driver).isNotNull()), [driver], sums={"total_volume_tons": volume},
                            means={"avg_delay_hours": delay, "delayed_share": "is_delayed", "avg_cost_per_km": "cost_per_km"}, rows="deliveries_count")
    return found.select(driver, "avg_delay_hours", "delayed_share", "avg_cost_per_km", "total_volume_tons", "deliveries_count")


def route_recommendation(cost_routes: DataFrame) -> DataFrame:
    """Dense rank of mean cost per km, 1 = cheapest."""
    return rank_asc(cost_routes, "avg_cost_per_km", out="recommendation")


def logistics_marts(deliveries: DataFrame, category: str = "category", route: str = "route",
                    driver: str = "driver_id") -> dict[str, DataFrame]:
    """Enriched deliveries and the four logistics marts."""
    enriched = enrich_deliveries(deliveries)
    cost = cost_by_route(enriched, route)
    return {
        "mart_delivery_delay_weather": delay_by_category(enriched, category),
        "mart_delivery_cost_distance": cost,
        "mart_driver_kpi": driver_kpi(enriched, driver),
        "mart_route_optimization": route_recommendation(cost),
        "deliveries_enriched": enriched,
    }
