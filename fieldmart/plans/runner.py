"""The four jobs of the reference in order, on one SparkSession, over
tables named and typed like the reference's sources.

Each job returns its marts as DataFrames; ``run_all`` writes them (S2/S3),
the raw snapshots (S7) and the run manifest (S9). The cleaned tables are
written once and re-read, so every mart scans them instead of recomputing
the cleaning (and a lost executor re-reads files instead of recomputing).
A failing job stops the run (as the reference's runner does).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart import schemas
from fieldmart.operators import logistics
from fieldmart.operators.joins import out_of_range_days
from fieldmart.plans import anomaly as anomaly_job
from fieldmart.plans import forecast
from fieldmart.plans.production import build_production_marts
from fieldmart.session import materialize, release_materialized, size_partitions
from fieldmart.sources import sinks

# The reference's cleaning parameters and feature lists.
TELEMETRY_MEASURES = ["pressure_atm", "temperature_c", "power_kw", "pump_runtime_hours", "energy_kwh"]
TELEMETRY_RANGES = {"temperature_c": (20.0, 130.0), "pressure_atm": (40.0, 220.0)}
DAILY_MEANS = {"avg_pressure_atm": "pressure_atm", "avg_temperature_c": "temperature_c",
               "avg_power_kw": "power_kw", "avg_energy_kwh": "energy_kwh"}
DAILY_SUMS = {"pump_runtime_hours": "pump_runtime_hours"}
FORECAST_MEANS = {"avg_pressure_atm": "pressure_atm", "avg_temperature_c": "temperature_c",
                  "avg_power_kw": "power_kw"}
FORECAST_FEATURES = ["avg_pressure_atm", "avg_temperature_c", "avg_power_kw", "pump_runtime_hours"]
SENSOR_FEATURES = ["vibration_mm_s", "temperature_c", "current_a", "rpm"]


def load_sources(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """S1 with the declared schemas."""
    from fieldmart.sources.tables import read_table

    return {n: read_table(spark, root, n, fmt, schema=s) for n, s in schemas.SOURCES.items()}


# The serial key of each source table (JDBC reads split on it).
SERIAL_KEYS = {"production": "production_id", "telemetry": "telemetry_id", "well_targets": "target_id",
               "pump_sensors": "sensor_id", "pump_failures": "failure_id", "deliveries": "delivery_id"}


def load_sources_jdbc(spark: SparkSession, url: str, properties: dict | None = None,
                      num_partitions: int | None = None) -> dict[str, DataFrame]:
    """S1 over JDBC: each table read in ``num_partitions`` key ranges, cast to
    the declared schema (the database may widen or rename types)."""
    from fieldmart.sources.tables import read_jdbc

    out = {}
    for name, schema in schemas.SOURCES.items():
        df = read_jdbc(spark, url, name, SERIAL_KEYS.get(name), num_partitions=num_partitions,
                       properties=properties)
        cols = {c.lower(): c for c in df.columns}
        out[name] = df.select(*[F.col(cols[f.name.lower()]).cast(f.dataType).alias(f.name) for f in schema.fields])
    return out


def production_job(src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """L1 + L2 + L3 with the reference's column names."""
    return build_production_marts(
        schemas.to_compute(src["production"]), schemas.to_compute(src["telemetry"]), src["wells"],
        key="well_id", day="production_date", ts="event_time", flow="flow_rate_tpd", oil="oil_tons",
        water="water_cut_pct", downtime="downtime_hours", measures=TELEMETRY_MEASURES, ranges=TELEMETRY_RANGES,
        runtime="pump_runtime_hours", reading_means=DAILY_MEANS, reading_sums=DAILY_SUMS,
        pressure="avg_pressure_atm", temperature="avg_temperature_c",
        well_columns={"well_name": "well_name", "field_name": "field_name", "region": "region", "status": "status"},
        keep=materialize)


def forecast_job(src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """L4 on raw telemetry (T19) and the targets."""
    tele = schemas.to_compute(src["telemetry"])
    targets = schemas.to_compute(src["well_targets"]).withColumnRenamed("target_date", "day")
    ds = forecast.flow_dataset(targets, tele, FORECAST_MEANS, DAILY_SUMS, key="well_id", day="day",
                               ts="event_time")
    ds = materialize(ds, "flow_dataset")
    preds, metrics = forecast.train_and_predict(ds, FORECAST_FEATURES, ["well_id", "day"])
    return {"mart_flow_predictions": preds.withColumnRenamed("day", "target_date"), "ml_flow_metrics": metrics}


def anomaly_job_run(src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """L5."""
    sensors = schemas.to_compute(src["pump_sensors"])
    failures = src["pump_failures"]
    lab = anomaly_job.add_zscores_and_labels(sensors, failures, SENSOR_FEATURES, key="pump_id",
                                             ts="event_time", failure_time="failure_time")
    lab = materialize(lab, "pump_labelled")
    risk, metrics = anomaly_job.train_failure_model(lab, SENSOR_FEATURES, ["sensor_id"])
    out = anomaly_job.risk_outputs(risk.withColumnRenamed("event_time", "ts"), key="pump_id", ts="ts",
                                   sensor_cols=SENSOR_FEATURES, extra=["well_id"])
    return {k: v.withColumnRenamed("ts", "event_time") for k, v in out.items()} | {"ml_failure_metrics": metrics}


def logistics_job(src: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """L6."""
    v = schemas.to_compute(src["deliveries"]).select(
        "delivery_id", "delivery_date", "route", "driver_id", F.col("weather").alias("category"),
        F.col("volume_tons").alias("volume"), F.col("distance_km").alias("distance"),
        F.col("cost_rub").alias("cost"), F.col("delay_hours").alias("delay"))
    m = logistics.logistics_marts(v)
    m["mart_delivery_delay_weather"] = m["mart_delivery_delay_weather"].withColumnRenamed("category", "weather")
    return m


JOBS = [("production", production_job), ("forecast", forecast_job),
        ("anomaly", anomaly_job_run), ("logistics", logistics_job)]


# Marts that their job has already written as tables.
WRITTEN = {"clean_production", "clean_telemetry", "mart_well_kpi", "features_well_daily"}


def run_all(spark: SparkSession, src: dict[str, DataFrame], out_root: str,
            jdbc_out: tuple[str, dict] | None = None) -> DataFrame:
    """Run the jobs in order; write raw snapshots, marts and the manifest.
    Days of production outside the calendar are reported beside the manifest.
    With ``jdbc_out=(url, properties)`` every mart is also replaced in that
    database (S2, batches of 1,000 rows). Returns the manifest DataFrame."""
    raw = {
        "raw/wells": (src["wells"], None),
        "raw/production": (src["production"], "production_date"),
        "raw/telemetry": (src["telemetry"].withColumn("event_date", F.to_date("event_time")), "event_date"),
        "raw/deliveries": (src["deliveries"], "delivery_date"),
        "raw/pump_sensors": (src["pump_sensors"].withColumn("event_date", F.to_date("event_time")), "event_date"),
    }
    manifests = [sinks.export_partitioned(df, out_root, name, key) for name, (df, key) in raw.items()]
    sinks.write_report(out_of_range_days(src["production"], "well_id", "production_date"), f"{out_root}/artifacts/out_of_range_days")
    tables = []
    for _, job in JOBS:
        for name, df in job(src).items():
            problems = schemas.check_mart(df, name)                       # C5 before the write
            if problems:
                raise ValueError(f"{name}: " + "; ".join(problems))
            tables.append(name)
            if name not in WRITTEN:
                df = materialize(df, name)                                # every sink below reads the files
            if jdbc_out is not None:
                sinks.write_jdbc(df, jdbc_out[0], name, properties=jdbc_out[1])
            if name.startswith("ml_"):
                sinks.write_report(df, f"{out_root}/artifacts/{name}")       # S10
            manifests.append(sinks.export_partitioned(df, out_root, f"processed/{name}",
                                                      sinks.route_partition_key(df, ("production_date", "event_date",
                                                                                     "target_date", "delivery_date"))))
    manifest = manifests[0]
    for m in manifests[1:]:
        manifest = manifest.unionByName(m)
    manifest = materialize(manifest, "manifest")
    sinks.write_manifest(manifest, f"{out_root}/artifacts/manifest", tables)
    return manifest


def main(argv: list[str] | None = None) -> None:
    """``python -m fieldmart.plans.runner --out DIR (--parquet DIR | --jdbc URL)``:
    run the four jobs over the seven source tables and write every mart."""
    import argparse

    from fieldmart.session import get_session

    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--out", required=True, help="output root on a shared file system")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--parquet", help="folder holding <table>.parquet for the seven sources")
    src.add_argument("--jdbc", help="JDBC URL of the source database")
    ap.add_argument("--jdbc-driver", default=None)
    ap.add_argument("--jdbc-out", default=None, help="JDBC URL that also receives every mart")
    ap.add_argument("--master", default=None)
    ap.add_argument("--jdbc-ranges", type=int, default=None, help="ranges of each JDBC read (default: the session's parallelism)")
    args = ap.parse_args(argv)
    spark = get_session(args.master, app_name="fieldmart-pipeline")
    if args.parquet:
        size_partitions(spark, [f"{args.parquet.rstrip('/')}/{t}.parquet" for t in schemas.SOURCES])
        sources = load_sources(spark, args.parquet)
    else:
        props = {"driver": args.jdbc_driver} if args.jdbc_driver else None
        sources = load_sources_jdbc(spark, args.jdbc, props, args.jdbc_ranges)
    out_db = (args.jdbc_out, {"driver": args.jdbc_driver} if args.jdbc_driver else {}) if args.jdbc_out else None
    manifest = run_all(spark, sources, args.out, jdbc_out=out_db)
    print(manifest.groupBy("dataset").agg(F.sum("rows_count").alias("rows")).orderBy("dataset").toPandas()
          .to_string(index=False))
    release_materialized(spark)


if __name__ == "__main__":
    main()
