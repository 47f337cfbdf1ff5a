"""Source schemas of the reference's seven tables (fixed at the source, never
inferred) and the column lists of the marts, checked before writes (C5).

NUMERIC columns are read as decimals at the source and computed on as
doubles (``to_compute``), keeping sums order-independent at the boundary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DecimalType, DoubleType, LongType, StringType, StructField,
                               StructType, TimestampNTZType)


def _s(*fields):
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


# The reference's table definitions (names, types, NOT NULL).
WELLS = _s(("well_id", StringType(), False), ("well_name", StringType(), False),
           ("field_name", StringType(), False), ("region", StringType(), False),
           ("start_date", DateType(), False), ("status", StringType(), False),
           ("depth_m", DecimalType(10, 2), False))
PRODUCTION = _s(("production_id", LongType(), False), ("well_id", StringType(), False),
                ("production_date", DateType(), False), ("flow_rate_tpd", DecimalType(12, 3), True),
                ("oil_tons", DecimalType(12, 3), True), ("water_cut_pct", DecimalType(6, 2), True),
                ("downtime_hours", DecimalType(6, 2), True))
TELEMETRY = _s(("telemetry_id", LongType(), False), ("well_id", StringType(), False),
               ("event_time", TimestampNTZType(), False), ("pressure_atm", DecimalType(10, 3), True),
               ("temperature_c", DecimalType(10, 3), True), ("power_kw", DecimalType(10, 3), True),
               ("pump_runtime_hours", DecimalType(10, 3), True), ("energy_kwh", DecimalType(12, 3), True))
WELL_TARGETS = _s(("target_id", LongType(), False), ("well_id", StringType(), False),
                  ("target_date", DateType(), False), ("actual_flow_rate_tpd", DecimalType(12, 3), False))
PUMP_SENSORS = _s(("sensor_id", LongType(), False), ("pump_id", StringType(), False),
                  ("well_id", StringType(), False), ("event_time", TimestampNTZType(), False),
                  ("vibration_mm_s", DecimalType(10, 3), True), ("temperature_c", DecimalType(10, 3), True),
                  ("current_a", DecimalType(10, 3), True), ("rpm", DecimalType(10, 3), True))
PUMP_FAILURES = _s(("failure_id", LongType(), False), ("pump_id", StringType(), False),
                   ("well_id", StringType(), False), ("failure_time", TimestampNTZType(), False),
                   ("failure_type", StringType(), False), ("repair_hours", DecimalType(10, 2), False))
DELIVERIES = _s(("delivery_id", LongType(), False), ("delivery_date", DateType(), False),
                ("route", StringType(), False), ("driver_id", StringType(), False),
                ("volume_tons", DecimalType(12, 3), False), ("distance_km", DecimalType(12, 3), False),
                ("cost_rub", DecimalType(14, 2), False), ("delay_hours", DecimalType(10, 3), False),
                ("weather", StringType(), False))

SOURCES = {"wells": WELLS, "production": PRODUCTION, "telemetry": TELEMETRY, "well_targets": WELL_TARGETS,
           "pump_sensors": PUMP_SENSORS, "pump_failures": PUMP_FAILURES, "deliveries": DELIVERIES}

# Columns and types of the marts. Beyond the
# reference's columns: bin indexes of the heatmap, the split flag of the
# predictions, and the date that partitions the pump marts' exports.
_WELL_KPI = ("well_id string, avg_flow_rate_tpd double, total_oil_tons double, downtime_hours double, days_count bigint, "
             "well_name string, field_name string, region string, status string, downtime_pct double")
_ROUTE_COST = "route string, avg_distance_km double, avg_cost_rub double, avg_cost_per_km double, deliveries_count bigint"
MART_SCHEMAS = {
    "clean_production": "production_id bigint, well_id string, production_date date, flow_rate_tpd double, oil_tons double, "
                        "water_cut_pct double, downtime_hours double",
    "clean_telemetry": "telemetry_id bigint, well_id string, event_time timestamp_ntz, pressure_atm double, temperature_c double, "
                       "power_kw double, pump_runtime_hours double, energy_kwh double, event_date date",
    "mart_production_daily": "production_date date, total_oil_tons double, avg_flow_rate_tpd double, total_downtime_hours double, "
                             "active_wells bigint",
    "mart_well_kpi": _WELL_KPI,
    "mart_well_ranking": _WELL_KPI + ", rank_by_flow bigint, well_group string",
    "features_well_daily": "well_id string, production_date date, production_id bigint, flow_rate_tpd double, oil_tons double, "
                           "water_cut_pct double, downtime_hours double, avg_pressure_atm double, avg_temperature_c double, "
                           "avg_power_kw double, avg_energy_kwh double, pump_runtime_hours double, downtime_ratio double, "
                           "field_name string, region string",
    "mart_pressure_flow_heatmap": "pressure_bin_idx int, pressure_bin string, temperature_bin_idx int, temperature_bin string, "
                                  "avg_flow_rate_tpd double, observations bigint",
    "mart_flow_predictions": "well_id string, target_date date, target_id bigint, actual_flow_rate_tpd double, "
                             "avg_pressure_atm double, avg_temperature_c double, avg_power_kw double, pump_runtime_hours double, "
                             "is_test int, predicted_flow_rate_tpd double, absolute_error double, model_name string",
    "ml_flow_metrics": "model_name string, mae double, rmse double, rows_train int, rows_test int, created_at timestamp",
    "mart_pump_anomalies": "pump_id string, well_id string, event_time timestamp_ntz, vibration_mm_s double, temperature_c double, "
                           "current_a double, rpm double, is_anomaly int, failure_within_7d int, risk_score double, event_date date",
    "mart_pump_risk": "pump_id string, well_id string, event_time timestamp_ntz, risk_score double, failure_within_7d int, "
                      "is_anomaly int, event_date date",
    "ml_failure_metrics": "model_name string, accuracy double, roc_auc double, rows_train int, rows_test int",
    "mart_delivery_delay_weather": "weather string, avg_delay_hours double, delayed_share double, deliveries_count bigint",
    "mart_delivery_cost_distance": _ROUTE_COST,
    "mart_driver_kpi": "driver_id string, avg_delay_hours double, delayed_share double, avg_cost_per_km double, "
                       "total_volume_tons double, deliveries_count bigint",
    "mart_route_optimization": _ROUTE_COST + ", recommendation bigint",
    "deliveries_enriched": "delivery_id bigint, delivery_date date, route string, driver_id string, category string, volume double, "
                           "distance double, cost double, delay double, cost_per_km double, is_delayed int",
}


def mart_schema(mart: str) -> StructType:
    return StructType.fromDDL(MART_SCHEMAS[mart])


def to_compute(df: DataFrame) -> DataFrame:
    """Decimals -> doubles for computation. Sums and means of doubles are
    exact (``functions.exact``), so they don't depend on row order."""
    return df.select(*[F.col(f.name).cast(DoubleType()).alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f.name) for f in df.schema.fields])


def check_mart(df: DataFrame, mart: str) -> list[str]:
    """C5 for marts: missing, unexpected or mistyped columns (empty: conforms)."""
    from fieldmart.operators.quality import check_schema

    return check_schema(df, mart_schema(mart)) if mart in MART_SCHEMAS else [f"unknown mart {mart}"]
