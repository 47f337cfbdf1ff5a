"""Time-varying curriculum: sources mixed to target weights over training time.

Sources, in code point order with null last, weigh 3, 1, 2, 3, 1, 2, ... and
share a budget of tokens by weight; a source's target stops at ``repeat`` times
its size, and the excess is shared again by weight until no target is above.

Training time t runs from 0 to 1. The weight of source s at time t is its
target times ``1 + tilt * (2t - 1)``, whose integral over all time is the
target; tilts fall from +TILT to -TILT over the weights' cycle, so some sources
come early and some late. The documents of a source stand in a fixed shuffled
order (md5 of seed and doc_id); pass after pass through that order, the token at
cumulative demand c is due at the time t at which the integrated weight
``target * (t + tilt * (t*t - t))`` reaches c. Inverting it gives each document's
training position in each pass, and the words it gives in a pass are those that
the integrated weight makes due between its start and its end. The last document of the last pass is taken in
part, so a source's taken tokens equal its target, rounded to whole tokens.

Cumulative sizes are sums over range partitions of (source, shuffled order) and
a sum before each partition, so one source may hold most rows.

Null text: size 0, never due. Null source: a source of its own, the last one.
Null doc_id: shuffled by an empty id. Repeated rows: each is taken on its own.
Very long texts: a document's size is a number like any other; one larger than its
source's target is taken in part. Empty table: no rows. Extra columns are ignored; size 0 documents and those that
no pass reaches have taken 0 and no position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.llm.common import number_rows, partitions, written

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
REPEAT = 2
TILT = 0.8
SEED = "curriculum-1"


def n_words(text: str = "text") -> Column:
    """Number of runs of [^\\x20\\x09-\\x0D] in a text column; null: 0."""
    squeezed = F.regexp_replace(F.col(text), r"[^\x20\x09-\x0D]+", "w")
    return F.coalesce(F.length(F.regexp_replace(squeezed, r"[\x20\x09-\x0D]+", "")), F.lit(0)).cast("long")


def targets(sources: DataFrame, budget: float = BUDGET, repeat: int = REPEAT, weights: tuple = WEIGHTS) -> DataFrame:
    """``sources`` (source, source_size) with weight, tilt and target. The level
    (tokens per weight) rises until no new source is above its stop; each turn
    is one small sum over the sources that aren't."""
    cycle = len(weights)
    numbered = number_rows(sources, [F.col("source").asc_nulls_last()], "mix-sources", parts=min(16, partitions(sources.sparkSession)))
    turn = F.pmod("row_number", F.lit(cycle)).cast("int")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), turn + 1)
    step = 2 * TILT / max(cycle - 1, 1)
    t = (numbered.withColumn("weight", w).withColumn("tilt", F.round(F.lit(TILT) - turn * F.lit(step), 6))
         .withColumn("stop", (F.col("source_size") * repeat).cast("double")).drop("row_number"))
    total = float(t.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]) * budget
    full = F.lit(False)
    level = stopped = None
    while True:
        now = t.agg(F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("w"),
                    F.coalesce(F.sum(F.when(full, F.col("stop"))), F.lit(0.0)).alias("s"),
                    F.count(F.when(full, 1)).alias("n")).first()
        if now["n"] == stopped or not now["w"]:
            break
        level, stopped = (total - now["s"]) / now["w"], now["n"]
        full = F.col("stop") / F.col("weight") <= F.lit(level)
    level = level or 0.0
    return t.withColumn("target", F.least("stop", F.col("weight") * F.lit(level))).drop("stop")


def due(demand: Column, target: Column, tilt: Column) -> Column:
    """The time at which a source's integrated weight reaches ``demand``."""
    x = demand / target
    # tilt * t*t + (1 - tilt) * t - x = 0
    b = 1 - tilt
    root = F.sqrt(b * b + 4 * tilt * x)
    return F.when(target > 0, F.least(F.lit(1.0), 2 * x / (b + root)))


def words_due(time: Column, target: Column, tilt: Column, whole_target: Column) -> Column:
    """Words of a source due by ``time``: its integrated weight, in whole words (exact
    for targets up to some 10^13 words); all of its target at the end."""
    due_by = F.round(target * (time + tilt * (time * time - time))).cast("long")
    return F.coalesce(F.when(time >= 1, whole_target).otherwise(due_by), F.lit(0).cast("long"))


def cumulative(rows: DataFrame, name: str, ties: tuple = ()) -> DataFrame:
    """``rows`` (source, mix_order, size) with ``before``: the sizes before each
    row in its source's order; the columns ``ties`` order rows of one id and size."""
    order = ["mix_order", "doc_id", "size", *ties]
    placed = written(rows.repartitionByRange(partitions(rows.sparkSession), "source", *order)
                     .withColumn("_part", F.spark_partition_id()), name)
    by_part = placed.groupBy("source", "_part").agg(F.sum("size").alias("_size"))  # a source's parts are few: a part holds many rows
    w = Window.partitionBy("source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_part.select(F.col("source").alias("_s"), F.col("_part").alias("_p"), F.coalesce(F.sum("_size").over(w), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("source", "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(starts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")))
            .withColumn("before", F.col("_start") + F.col("_in")).drop("_s", "_p", "_start", "_in", "_part"))


def mix(sizes: DataFrame, budget: float = BUDGET, repeat: int = REPEAT, weights: tuple = WEIGHTS, seed: str = SEED, ties: tuple = ()) -> DataFrame:
    """``sizes`` (doc_id, source, size and other narrow columns) with
    source_size, target, taken and positions (array of the document's training
    times, one for each pass that takes some of it). The columns ``ties`` order
    rows of one doc_id and size."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sizes = written(sizes.withColumn("mix_order", order), "mix-sizes")
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = written(targets(by_source, budget, repeat, weights), "mix-targets")
    goals = goals.withColumn("whole_target", F.round("target").cast("long")).withColumnRenamed("source", "_source")
    rows = cumulative(sizes, "mix-order", ties).join(goals, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    target, tilt, whole = F.col("target"), F.col("tilt"), F.col("whole_target")
    # a pass takes of a document the words that the weights make due between its first and last word's times
    starts = [F.least(F.col("before") + F.col("source_size") * k, whole) for k in range(repeat)]
    times = [due(at.cast("double"), target, tilt) for at in starts]
    ends = [due(F.least(at + F.col("size"), whole).cast("double"), target, tilt) for at in starts]
    takes = [words_due(end, target, tilt, whole) - words_due(time, target, tilt, whole) for time, end in zip(times, ends)]
    times = F.array(*[F.when(take > 0, time) for take, time in zip(takes, times)])
    return rows.withColumn("taken", sum(takes[1:], takes[0]).cast("long")).withColumn("positions", F.array_compact(times)).drop("before", "whole_target")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix of ``docs`` (doc_id, text, source): one row per document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words().alias("size"))
    return mix(rows, **options).select("doc_id", "source", "size", "source_size", "weight", "tilt", "target", "taken", "positions")


def training_order(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as training reads them, with ``training_position``: a row for
    each time a document is taken, range-sorted by position. The rows are numbered
    in a written table, so each has its own draws, repeated rows too."""
    rows = written(docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), n_words().alias("size"),  # the columns' own names can't clash
                               F.xxhash64(F.col("text").cast("string")).alias("text_hash"), F.monotonically_increasing_id().alias("row_id")), "mix-rows")
    sizes = rows.select("row_id", F.col("row.doc_id").cast("long").alias("doc_id"), F.col("row.source").cast("string").alias("source"), "size", "text_hash")
    drawn = mix(sizes, ties=("text_hash", "row_id"), **options).where(F.size("positions") > 0).select("row_id", F.col("doc_id").alias("id"), "positions")
    taken = rows.select("row", "row_id").join(drawn, "row_id").select("row", "row_id", "id", F.explode("positions").alias("position"))
    order = ["position", "id", "row_id"]
    ordered = taken.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    return ordered.select(*[F.col("row")[c].alias(c) for c in docs.columns if c != "training_position"], F.col("position").alias("training_position"))
