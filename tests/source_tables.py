"""Seven small source tables with the declared schemas, for the job tests.

Values are this test's own: noise is the hash of a row's ids scaled to a range,
faults sit on chosen rows. They give every cleaning rule something to do: missing
water cuts, flows far over the fence, downtimes beyond a day, missing pressures,
temperatures out of range, bursts in the pump sensors on two known days, two
failures, and deliveries in four kinds of weather."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldmart import schemas

START = "2026-01-01"
SITES = [("well_001", "Alder", "Ridge", "North"), ("well_002", "Birch", "Ridge", "South"),
         ("well_003", "Cedar", "Basin", "North"), ("well_004", "Dogwood", "Basin", "South")]
BURST_DAYS = (12, 13)
WEATHER = ("clear", "rain", "snow", "fog")


def noise(low: float, high: float, *ids) -> Column:
    """A number in [low, high) that depends on the ids only, with 3 decimals."""
    return F.round(F.lit(low) + (high - low) * F.pmod(F.xxhash64(*ids), F.lit(10_000)) / 10_000.0, 3)


def grid(sites, steps: int, hours: int, serial: str):
    """One row per site and step, with a serial id from 1 and the step's time."""
    at = F.lit(f"{START} 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), (F.col("step") * hours).cast("int"))
    rows = sites.select("well_id", F.posexplode(F.sequence(F.lit(1), F.lit(steps))).alias("step", "_n")).drop("_n")
    number = (F.substring("well_id", 6, 3).cast("int") - 1) * steps + F.col("step") + 1
    return rows.withColumn(serial, number).withColumn("at", at)


def build_sources(spark, wells: int = 4, days: int = 40):
    sites = spark.createDataFrame(SITES[:wells], "well_id string, well_name string, field_name string, region string")
    w = sites.select("*", F.lit("2020-06-01").cast("date").alias("start_date"),
                     F.when(F.col("well_id") == "well_004", "maintenance").otherwise("active").alias("status"),
                     noise(900, 2500, "well_id").alias("depth_m"))

    p = grid(sites, days, 24, "production_id")
    flow = noise(40, 60, "well_id", "step")
    p = p.select("production_id", "well_id", F.to_date("at").alias("production_date"),
                 F.when(F.col("step") % 20 == F.substring("well_id", 6, 3).cast("int") + 4, flow * 5).otherwise(flow).alias("flow_rate_tpd"),
                 F.when(F.col("step") == 15, None).otherwise(flow * 0.8).alias("oil_tons"),
                 F.when(F.col("step").isin(3, 18, 33), None).otherwise(noise(5, 25, "step", "well_id")).alias("water_cut_pct"),
                 F.when(F.col("step") == 22, F.lit(26.5)).otherwise(noise(0, 3, "production_id")).alias("downtime_hours"))

    t = grid(sites, days * 4, 6, "telemetry_id")
    t = t.select("telemetry_id", "well_id", F.col("at").alias("event_time"),
                 F.when(F.col("step") % 41 == 5, None).otherwise(noise(80, 120, "telemetry_id", F.lit("p"))).alias("pressure_atm"),
                 F.when(F.col("step") % 53 == 9, F.lit(300.0)).otherwise(noise(45, 75, "telemetry_id", F.lit("t"))).alias("temperature_c"),
                 noise(20, 50, "telemetry_id", F.lit("w")).alias("power_kw"),
                 noise(4, 6, "telemetry_id", F.lit("r")).alias("pump_runtime_hours"),
                 noise(100, 300, "telemetry_id", F.lit("e")).alias("energy_kwh"))

    targets = p.select(F.col("production_id").alias("target_id"), "well_id", F.col("production_date").alias("target_date"),
                       F.coalesce("flow_rate_tpd", "oil_tons").alias("actual_flow_rate_tpd"))

    s = grid(sites, days * 2, 12, "sensor_id")
    burst = F.dayofmonth("at").isin(*BURST_DAYS) & (F.month("at") == 1)
    s = s.select("sensor_id", F.concat(F.lit("pump_"), F.substring("well_id", 6, 3)).alias("pump_id"), "well_id", F.col("at").alias("event_time"),
                 *[F.when(burst, F.lit(high)).otherwise(noise(low, low * 1.1, "sensor_id", F.lit(name))).alias(name)
                   for name, low, high in (("vibration_mm_s", 2.0, 9.0), ("temperature_c", 50.0, 95.0), ("current_a", 30.0, 55.0), ("rpm", 1400.0, 900.0))])

    f = spark.createDataFrame(
        [(1, "pump_002", "well_002", "2026-01-16 07:30:00", "bearing", 6.0), (2, "pump_003", "well_003", "2026-02-03 19:00:00", "seal", 3.5)],
        "failure_id long, pump_id string, well_id string, failure_time string, failure_type string, repair_hours double"
    ).withColumn("failure_time", F.col("failure_time").cast("timestamp_ntz"))

    n = days * 8
    dv = spark.range(1, n + 1).select(F.col("id").alias("delivery_id"), F.date_add(F.lit(START).cast("date"), (F.col("id") % days).cast("int")).alias("delivery_date"),
                                      F.format_string("route %d", F.col("id") % 5).alias("route"), F.format_string("driver_%02d", F.col("id") % 8).alias("driver_id"),
                                      noise(10, 90, "id").alias("volume_tons"), noise(30, 400, "id", F.lit("d")).alias("distance_km"), noise(5000, 60000, "id", F.lit("c")).alias("cost_rub"),
                                      F.when(F.pmod(F.xxhash64("id"), F.lit(6)) == 0, noise(2.5, 8, "id")).otherwise(noise(0, 1.9, "id")).alias("delay_hours"),
                                      F.element_at(F.array(*[F.lit(x) for x in WEATHER]), (F.pmod(F.xxhash64("id", F.lit("w")), F.lit(4)) + 1).cast("int")).alias("weather"))

    raw = {"wells": w, "production": p, "telemetry": t, "well_targets": targets, "pump_sensors": s, "pump_failures": f, "deliveries": dv}
    return {name: df.select(*[F.col(c.name).cast(c.dataType).alias(c.name) for c in schemas.SOURCES[name].fields]) for name, df in raw.items()}
