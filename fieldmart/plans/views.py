"""The reference's data model on the driver's tables (FIXTURES.md §3).

| view | stands for | built from |
|---|---|---|
| ``daily_fact`` (d) | production | lineitem per (supplier, ship day) |
| ``readings`` (r) | telemetry / pump sensors | events (+ k from props, runtime = k/4) |
| ``user_daily_fact`` (u) | production on the readings' entities | r per (user, day) |
| ``supplier_entities`` / ``customer_entities`` (e) | wells | supplier/customer + nation + region |
| ``failures`` (f) | pump failures | events of type 'error' with value > 100 |
| ``deliveries`` (v) | deliveries | lineitem |

The driver's tables hold no NULLs, so the seed's controlled faults are
injected with a deterministic key hash (U4), as the reference's seed does
with its serial ids. Every view reads the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldmart.functions.expressions import key_hash
from fieldmart.sources.tables import nan_to_null_all, read_table

# Fault injection moduli of the fixtures (FIXTURES.md §3).
FACT_WATER_NULL, FACT_FLOW_NULL, FACT_OIL_NULL, FACT_FLOW_X4 = 97, 101, 103, 173
READ_VALUE_NULL, READ_K_NULL, READ_VALUE_X4 = 97, 151, 173
FAILURE_TYPE, FAILURE_MIN_VALUE = "error", 100.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return nan_to_null_all(read_table(spark, sf_dir, name))


def daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    d0 = li.groupBy(F.col("l_suppkey").alias("entity_id"), F.to_date("l_shipdate").alias("day")).agg(
        F.avg("l_extendedprice").alias("flow"), F.sum("l_quantity").alias("oil"),
        (F.avg("l_discount") * 100).alias("water"), (F.sum("l_tax") * 100).alias("downtime"))
    h = key_hash("entity_id", "day")
    return d0.select(
        "entity_id", "day",
        F.when(h % FACT_FLOW_NULL == 0, F.lit(None))
         .when(h % FACT_FLOW_X4 == 0, F.col("flow") * 4).otherwise(F.col("flow")).alias("flow"),
        F.when(h % FACT_OIL_NULL == 0, F.lit(None)).otherwise(F.col("oil")).alias("oil"),
        F.when(h % FACT_WATER_NULL == 0, F.lit(None)).otherwise(F.col("water")).alias("water"),
        "downtime")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    k = F.when(eid % READ_K_NULL == 0, F.lit(None)).otherwise(
        F.get_json_object("props", "$.k").cast("double"))
    return ev.select(
        eid, F.col("user_id").alias("entity_id"), "ts", "event_type",
        F.when(eid % READ_VALUE_NULL == 0, F.lit(None))
         .when(eid % READ_VALUE_X4 == 0, F.col("value") * 4).otherwise(F.col("value")).alias("value"),
        k.alias("k"), (k / 4).alias("runtime"))


def user_daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = readings(spark, sf_dir)
    return r.groupBy("entity_id", F.to_date("ts").alias("day")).agg(
        F.avg("value").alias("flow"), F.sum("value").alias("oil"), F.avg("k").alias("water"),
        F.coalesce(F.sum(F.when(F.col("event_type") == FAILURE_TYPE, F.col("runtime"))), F.lit(0.0))
         .alias("downtime"))


def _entities(spark, sf_dir, base: str, key: str, name: str, nation_key: str, acct: str) -> DataFrame:
    b = table(spark, sf_dir, base)
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (b.join(n, b[nation_key] == n["n_nationkey"], "left")
             .join(r, n["n_regionkey"] == r["r_regionkey"], "left")
             .select(b[key].alias("entity_id"), b[name].alias("name"), n["n_name"].alias("field"),
                     r["r_name"].alias("region"),
                     F.when(b[acct] < 0, "maintenance").otherwise("active").alias("status")))


def supplier_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entities(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")


def customer_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _entities(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_acctbal")


def spikes(spark: SparkSession, sf_dir: str, event_type: str, limit: float) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.where((F.col("event_type") == event_type) & (F.col("value") > limit) & ~F.isnan("value"))


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The filter reaches the scan: NaN is excluded beside it, not wrapped around it.
    return (spikes(spark, sf_dir, FAILURE_TYPE, FAILURE_MIN_VALUE).select(F.col("user_id").alias("entity_id"), F.col("ts").alias("failure_time")))


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.to_date("l_shipdate").alias("delivery_date"),
        (F.col("l_suppkey") % 8).alias("route"),
        F.col("l_suppkey").alias("driver_id"),
        F.col("l_returnflag").alias("category"),
        F.col("l_quantity").alias("volume"),
        (F.col("l_quantity") * 10).alias("distance"),
        F.col("l_extendedprice").alias("cost"),
        F.round(F.col("l_tax") * 100).alias("delay"))
