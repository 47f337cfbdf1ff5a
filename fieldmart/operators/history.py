"""Statistics that are kept from run to run (W1, W2, A15, A16; A1-A4 by merge).

``add_counts`` stores how often each value of each entity occurs, one part per call
(a day, say); writing a part again replaces it. ``stored_quantiles`` answers exact
quantiles from the parts without ranking all history: values are kept in buckets of a
rising function, the buckets' counts tell which few of them hold the asked positions,
and only their values are ranked (by :func:`counted_order`, so a hot entity's bucket
is cut into ranges). Missing values are counted, too, which is what the median fill
turns into medians before the fences are taken.

``add_daily_states`` stores the partial sums of a fact per (entity, date) in one folder
per date; writing a date again replaces it. Marts are merged from them: sums and means
equal a rebuild from the rows bit by bit (:mod:`fieldmart.functions.exact`), distinct
entities and days are counted over the states' keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldmart.functions import exact
from fieldmart.operators import clean, marts
from fieldmart.operators.positions import GROUP_N, POS, counted_order, interpolated, present
from fieldmart.session import row_partitions
from fieldmart.sources.sinks import MANIFEST, read_export, rows_by_date, write_dates

#: Buckets per unit of log(1 + |x|).
FINE = 64


def _bucket(x: Column) -> Column:
    return F.floor(F.signum(x) * F.log1p(F.abs(x)) * F.lit(float(FINE)))


def value_counts(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, column name, bucket, value, count) of a frame's values per entity; a NULL
    value stands for the missing ones. Rows without an entity are left out (T2)."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias("value")) for c in columns])
    stacked = present(df, [key]).select(key, F.inline(cells))
    # -0.0 and 0.0 are one value
    stacked = stacked.withColumn("value", F.when(F.col("value") == 0, F.lit(0.0)).otherwise(F.col("value")))
    return stacked.groupBy(key, "column", _bucket(F.col("value")).alias("bucket"), "value").agg(F.count(F.lit(1)).alias("count"))


def add_counts(df: DataFrame, key: str, columns: Sequence[str], path: str, part: str) -> None:
    """Store the counts of ``df`` as the part ``part`` of the table at ``path``."""
    value_counts(df, key, columns).write.mode("overwrite").parquet(f"{path.rstrip('/')}/part={part}")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/part=*").drop("part")


def stored_quantiles(counts: DataFrame, key: str, columns: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """Exact quantiles with linear interpolation as :func:`positions.quantiles` gives
    them: key and one column ``{name}_{column}`` per (prob, column)."""
    kept = counts.where(F.col("value").isNotNull() & F.col("column").isin(list(columns)))
    by = Window.partitionBy(key, "column")       # at most a few ten thousand buckets
    coarse = kept.groupBy(key, "column", "bucket").agg(F.sum("count").alias("_b"))
    coarse = coarse.select(key, "column", "bucket", "_b", F.coalesce(F.sum("_b").over(by.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
                           F.sum("_b").over(by).alias("_all"))
    h = {name: F.lit(float(p)) * (F.col("_all") - 1) for name, p in probs.items()}
    asked = F.lit(False)
    for x in h.values():
        for position in (F.floor(x), F.ceil(x)):
            asked = asked | ((F.col("_before") <= position) & (position < F.col("_before") + F.col("_b")))
    few = kept.join(coarse.where(asked).drop("_b"), [key, "column", "bucket"])
    few = few.groupBy(key, "column", "bucket", "_before", "_all", "value").agg(F.sum("count").alias("count"))
    placed = counted_order(few, [key, "column", "bucket"], ["value"], "count").drop(GROUP_N).withColumn(POS, F.col(POS) + F.col("_before"))

    picked = interpolated(placed.withColumnsRenamed({"value": "_x", "count": "_c"}), [key, "column"], F.col("_all"), F.col(POS), probs)
    return picked.groupBy(key).agg(*[F.max(F.when(F.col("column") == c, F.col(name))).alias(f"{name}_{c}") for c in columns for name in probs])


def stored_medians(counts: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    return stored_quantiles(counts, key, columns, {"_med": 0.5})


def stored_fences(counts: DataFrame, medians: DataFrame, key: str, column: str) -> DataFrame:
    """Quartiles of a column after its median fill."""
    own = counts.where(F.col("column") == column).join(medians.select(key, f"_med_{column}"), key, "left")
    filled = F.coalesce(F.col("value"), F.col(f"_med_{column}"))
    own = own.select(key, "column", F.coalesce(F.col("bucket"), _bucket(filled)).alias("bucket"), filled.alias("value"), "count")
    return stored_quantiles(own, key, [column], {"_q1": 0.25, "_q3": 0.75})


def clean_daily_fact(df: DataFrame, counts: DataFrame, key: str = "entity_id", flow: str = "flow", water: str = "water", **names) -> DataFrame:
    """L1 with medians and fences from the stored counts: the rows are read once and
    none is ranked. ``counts`` covers at least the rows' entities."""
    medians = stored_medians(counts, key, [water, flow])
    return clean.clean_daily_fact(df, key=key, flow=flow, water=water, medians=medians, fences=stored_fences(counts, medians, key, flow), **names)


def clean_readings(df: DataFrame, counts: DataFrame, key: str = "entity_id", measures: Sequence[str] = ("value", "k", "runtime"), **rules) -> DataFrame:
    """L2 with medians from the stored counts."""
    return clean.clean_readings(df, key=key, measures=measures, medians=stored_medians(counts, key, measures), **rules)


def add_daily_states(df: DataFrame, key: str, day: str, measures: Sequence[str], root: str, name: str) -> DataFrame:
    """Store the partial sums of ``measures`` per (entity, date) under ``root/name``, a
    folder per date of ``df``; those dates' old states go. Returns the manifest. Rows
    without a date or an entity are in no mart by date and entity (T2).

    The narrow rows move once, dealt by (date, entity): each task then adds its own pairs
    up and writes their wide states, which are never shuffled. A date is cut by entity; the
    rows of one pair meet in a task, where they only add to its state."""
    base = present(df.withColumn(day, F.to_date(day)), [key, day]).select(key, day, *measures)
    dates = rows_by_date(base, day)
    if not dates:
        return df.sparkSession.createDataFrame([], MANIFEST)
    spread = base.repartitionByRange(row_partitions(df.sparkSession, sum(dates.values())), day, key)
    states = exact.states(spread, [key, day], {m: m for m in measures})
    return write_dates(states, f"{root.rstrip('/')}/{name}", name, day, dates)


def daily_states(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_export(spark, f"{root.rstrip('/')}/{name}")


def production_daily(states: DataFrame, key: str = "entity_id", day: str = "day", flow: str = "flow", oil: str = "oil", downtime: str = "downtime") -> DataFrame:
    """A1 from stored states."""
    merged = exact.merge([states.drop(key)], [day], [flow, oil, downtime])
    sums = exact.finish(merged, [day], {"total_oil_tons": oil, "total_downtime_hours": downtime}, {"avg_flow_rate_tpd": flow})
    return sums.join(states.groupBy(day).agg(F.countDistinct(key).alias("active_wells")), day).select(*marts.daily_columns(day))


def entity_kpi(states: DataFrame, entities: DataFrame | None = None, key: str = "entity_id", day: str = "day", flow: str = "flow", oil: str = "oil",
               downtime: str = "downtime", entity_columns: Sequence[str] = ("name", "field", "region", "status")) -> DataFrame:
    """A2, J1 and E1 from stored states."""
    merged = exact.merge([states.drop(day)], [key], [flow, oil, downtime])
    sums = exact.finish(merged, [key], {"total_oil_tons": oil, "downtime_hours": downtime}, {"avg_flow_rate_tpd": flow})
    days = states.groupBy(key).agg(F.countDistinct(day).alias("days_count"))
    return marts.kpi_columns(sums.join(days, key), key, entities, entity_columns)


def readings_daily(states: DataFrame, means: Mapping[str, str], sums: Mapping[str, str], key: str = "entity_id", day: str = "day") -> DataFrame:
    """A3 and A4 from stored states."""
    return exact.finish(states, [key, day], sums, means).select(key, day, *means, *sums)
