"""Dashboard and notebook queries over the marts written by
:mod:`fieldmart.plans.runner`, under the marts' own table names.

``run_dashboard`` registers the marts as temporary views and returns one lazy
DataFrame per query; ``limit`` adds the notebooks' ``LIMIT`` where a query has
one (Q2, Q4, Q7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from fieldmart.operators import marts
from fieldmart.sources.tables import register_views

# The dashboard's SELECT statements, by query id.
DASHBOARD = {
    "q1_production_over_time":
        "SELECT production_date, total_oil_tons, avg_flow_rate_tpd FROM mart_production_daily "
        "ORDER BY production_date",
    "q2_top_wells":
        "SELECT well_name, avg_flow_rate_tpd, downtime_pct, total_oil_tons FROM mart_well_kpi "
        "ORDER BY avg_flow_rate_tpd DESC, well_id",
    "q3_pressure_temperature_heatmap":
        "SELECT pressure_bin, temperature_bin, avg_flow_rate_tpd, observations FROM mart_pressure_flow_heatmap "
        "ORDER BY pressure_bin_idx, temperature_bin_idx",
    "q4_actual_vs_predicted":
        "SELECT target_date, well_id, actual_flow_rate_tpd, predicted_flow_rate_tpd, absolute_error "
        "FROM mart_flow_predictions ORDER BY target_date, well_id",
    "q5_anomalies_over_time":
        "SELECT event_time, pump_id, vibration_mm_s, temperature_c, current_a, rpm, risk_score "
        "FROM mart_pump_anomalies ORDER BY event_time, pump_id",
    "q6_delay_by_weather":
        "SELECT weather, avg_delay_hours, delayed_share, deliveries_count FROM mart_delivery_delay_weather "
        "ORDER BY avg_delay_hours DESC, weather",
    "q7_driver_kpi":
        "SELECT driver_id, delayed_share, avg_cost_per_km, total_volume_tons, deliveries_count "
        "FROM mart_driver_kpi ORDER BY delayed_share, avg_cost_per_km, driver_id",
    "q8_model_metrics":
        "SELECT model_name, mae, rmse, rows_train, rows_test FROM ml_flow_metrics ORDER BY rmse",
    "q8_failure_model_metrics":
        "SELECT model_name, accuracy, roc_auc, rows_train, rows_test FROM ml_failure_metrics",
    "q10_cost_vs_distance":
        "SELECT route, avg_distance_km, avg_cost_rub FROM mart_delivery_cost_distance ORDER BY route",
    "q11_max_risk_per_pump":
        "SELECT pump_id, max(risk_score) AS max_risk FROM mart_pump_risk GROUP BY pump_id ORDER BY pump_id",
    "q12_risk_before_failure":
        "SELECT event_time, pump_id, risk_score FROM mart_pump_risk WHERE failure_within_7d = 1 "
        "ORDER BY pump_id, event_time",
    "q12_vibration_before_failure":
        "SELECT r.event_time, r.pump_id, s.vibration_mm_s, r.risk_score FROM mart_pump_risk r "
        "LEFT JOIN pump_sensors s ON s.pump_id = r.pump_id AND s.event_time = r.event_time "
        "WHERE r.failure_within_7d = 1 ORDER BY r.pump_id, r.event_time",
    "q13_downtime_by_day":
        "SELECT production_date, total_downtime_hours FROM mart_production_daily ORDER BY production_date",
    "q13_downtime_by_well":
        "SELECT well_id, well_name, downtime_hours, downtime_pct FROM mart_well_kpi "
        "ORDER BY downtime_pct DESC, well_id",
}
LIMITED = {"q2_top_wells", "q4_actual_vs_predicted", "q7_driver_kpi"}


def kpi_cards(features: DataFrame, date_from=None, date_to=None, regions: Sequence[str] | None = None,
              wells: Sequence[str] | None = None) -> DataFrame:
    """Q9: the four KPI cards under the dashboard's date / region / well filters."""
    f = marts.dashboard_filter(features, day="production_date", date_from=date_from, date_to=date_to,
                               regions=regions, entities=wells, key="well_id")
    return marts.kpi_cards(f, oil="oil_tons", flow="flow_rate_tpd", pressure="avg_pressure_atm",
                           downtime="downtime_hours")


def run_dashboard(spark: SparkSession, mart_frames: Mapping[str, DataFrame],
                  limit: int | None = None) -> dict[str, DataFrame]:
    """Register the marts and return every dashboard query whose marts are
    present (Q9 needs ``features_well_daily``, Q12 with vibration the source table
    ``pump_sensors`` beside the risk mart)."""
    register_views(spark, dict(mart_frames))
    out = {}
    for name, sql in DASHBOARD.items():
        needed = [w for before, w in zip(sql.split(), sql.split()[1:]) if before in ("FROM", "JOIN")]
        if not all(t in mart_frames for t in needed):
            continue
        df = spark.sql(sql)
        out[name] = df.limit(limit) if limit and name in LIMITED else df
    if "features_well_daily" in mart_frames:
        out["q9_kpi_cards"] = kpi_cards(mart_frames["features_well_daily"])
    return out
