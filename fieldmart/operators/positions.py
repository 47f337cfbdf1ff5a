"""Order statistics without putting a whole group into one task.

One helper carries them all. :func:`counted_order` takes rows with a count,
range-partitions them by (keys, order) -- so a hot key is cut into many tasks
by its order value -- and writes that frame once, with its partition numbers.
The counts of the (partition, key) segments, at most ``#partitions + #keys``
rows, say how much of a key lies before each partition; a window inside one
(partition, key) adds what lies before a row. Both readers see the same written
rows, whatever is recomputed.

Quantiles and AUC first reduce the data to counts per (key, value), so the
range shuffle moves distinct values, not rows. Positions are exact; rows that tie
on (key, order) may take either of their positions, which never changes a
quantile, a rank or a stratified count. There is one path for every size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldmart.session import default_parallelism, materialize, row_partitions

POS, GROUP_N = "_pos", "_n"


def present(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with every key; the rest never meets in one group."""
    for k in keys:
        df = df.where(F.col(k).isNotNull())
    return df


def counted_order(df: DataFrame, keys: Sequence[str], order: Sequence[str], count: str, descending: bool = False,
                  num_partitions: int | None = None) -> DataFrame:
    """``df`` with ``_pos``, the counts of all earlier rows of its key group,
    and ``_n``, the group's whole count."""
    n = num_partitions or default_parallelism(df.sparkSession)
    ordering = [F.col(o).desc() if descending else F.col(o).asc() for o in order]
    placed = materialize(df.repartitionByRange(n, *[F.col(k) for k in keys], *ordering)
                         .withColumn("_pid", F.spark_partition_id()), "counted-order")
    segment = placed.groupBy("_pid", *keys).agg(F.sum(count).alias("_s"))
    by_key = Window.partitionBy(*keys)
    earlier = by_key.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    segment = segment.select("_pid", *keys, F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_off"),
                             F.sum("_s").over(by_key).alias(GROUP_N))
    inside = Window.partitionBy("_pid", *keys).orderBy(*ordering).rowsBetween(Window.unboundedPreceding, -1)
    return (placed.withColumn("_in", F.coalesce(F.sum(count).over(inside), F.lit(0)))
            .join(segment, ["_pid", *keys])
            .withColumn(POS, F.col("_off") + F.col("_in")).drop("_pid", "_off", "_in"))


def with_group_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool = False,
                        num_partitions: int | None = None) -> DataFrame:
    """``keys + order`` columns with ``_pos`` (0-based position by ``order``
    inside the key group) and ``_n`` (group size). Rows with a NULL key are
    dropped; callers join payload back on a row key."""
    base = present(df.select(*dict.fromkeys([*keys, *order])), keys).withColumn("_one", F.lit(1).cast("bigint"))
    return counted_order(base, keys, order, "_one", descending, num_partitions).drop("_one")


def value_positions(df: DataFrame, keys: Sequence[str], columns: Sequence[str], num_partitions: int | None = None) -> DataFrame:
    """The distinct present values ``_x`` of each key and column number ``_ci``, how
    often they occur (``_c``), the position of the first (``POS``) and the number of
    all (``GROUP_N``)."""
    stacked = present(df, keys).select(*keys, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_ci"), F.col(c).cast("double").alias("_x")) for i, c in enumerate(columns)])).alias("_s"))
    stacked = stacked.select(*keys, "_s._ci", "_s._x").where(F.col("_x").isNotNull())
    counts = stacked.groupBy(*keys, "_ci", "_x").agg(F.count(F.lit(1)).alias("_c"))
    return counted_order(counts, [*keys, "_ci"], ["_x"], "_c", num_partitions=num_partitions)


def quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Mapping[str, float],
              num_partitions: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (A15/A16, T12) per key, for
    several columns at once. Missing values are ignored; a key whose values are
    all missing gets no row (callers left-join and read NULL). Output: keys + one
    column ``f"{name}_{column}"`` per (prob, column)."""
    return quantiles_at(value_positions(df, keys, columns, num_partitions), keys, columns, probs)


def quantiles_at(placed: DataFrame, keys: Sequence[str], columns: Sequence[str], probs: Mapping[str, float]) -> DataFrame:
    """:func:`quantiles` of values whose positions are known."""
    by_column = interpolated(placed, [*keys, "_ci"], F.col(GROUP_N), F.col(POS), probs)
    return by_column.groupBy(*keys).agg(*[F.max(F.when(F.col("_ci") == ci, F.col(name))).alias(f"{name}_{c}")
                                          for ci, c in enumerate(columns) for name in probs])


def interpolated(placed: DataFrame, by: Sequence[str], total: Column, start: Column, probs: Mapping[str, float], elsewhere: Column | None = None) -> DataFrame:
    """One column per prob for each group of rows (``_x`` from position ``start`` on,
    ``_c`` times, of ``total``); a position that no row holds has the value
    ``elsewhere``. One interpolation for every caller: lo + (hi - lo) * fraction."""
    rows = placed.select(*by, "_x", "_c", start.alias("_start"), total.alias("_total"), (F.lit(None).cast("double") if elsewhere is None else elsewhere).alias("_else"))

    def at(position):
        return F.max(F.when((F.col("_start") <= position) & (position < F.col("_start") + F.col("_c")), F.col("_x")))

    h = {name: F.lit(float(p)) * (F.col("_total") - 1) for name, p in probs.items()}
    picked = rows.groupBy(*by).agg(F.max("_total").alias("_total"), F.max("_else").alias("_else"), *[
        a for i, x in enumerate(h.values()) for a in (at(F.floor(x)).alias(f"_lo{i}"), at(F.ceil(x)).alias(f"_hi{i}"))])
    out = []
    for i, (name, x) in enumerate(h.items()):
        low, high = F.coalesce(f"_lo{i}", "_else"), F.coalesce(f"_hi{i}", "_else")
        out.append((low + (high - low) * (x - F.floor(x))).alias(name))
    return picked.select(*by, *out)


def ordered(df: DataFrame, by: Sequence[Column], num_partitions: int | None = None) -> DataFrame:
    """The rows written in the order ``by``: cut into ranges of it and sorted there, with
    their ids (``monotonically_increasing_id``)."""
    return materialize(df.repartitionByRange(num_partitions or default_parallelism(df.sparkSession), *by).sortWithinPartitions(*by)
                       .withColumn("_id", F.monotonically_increasing_id()), "ordered")


def numbered(rows: DataFrame, shown: Sequence[str | Column], out: str) -> DataFrame:
    """Columns of :func:`ordered` rows with their number (from 0) in the order. The id
    holds a row's number inside its range (the low 33 bits, as documented), and the
    ranges' sizes, one row each, give what lies before."""
    rows = rows.select(*shown, F.shiftrightunsigned("_id", 33).alias("_range"), F.col("_id").bitwiseAND((1 << 33) - 1).alias("_at"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_size")).select("_range", before.alias("_before"))
    return rows.join(F.broadcast(sizes), "_range").drop("_range").withColumn(out, F.col("_before") + F.col("_at")).drop("_before", "_at")  # one row a range


def medians_and_filled(df: DataFrame, key: str, columns: Sequence[str], column: str, probs: Mapping[str, float]) -> tuple[DataFrame, DataFrame]:
    """Medians ``_med_c`` of the columns per key, and quantiles ``{name}_{column}`` of
    one of them after its missing values took its median."""
    return ordered_statistics(df, key, columns, column, probs)[1:]


def ordered_statistics(df: DataFrame, key: str, columns: Sequence[str], column: str, probs: Mapping[str, float]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows that have a key, written in the order of (key, column), with the two
    statistics of :func:`medians_and_filled`.

    The rows move once. They are cut into ranges of (key, value, one of 64 numbers), so
    neither a frequent key nor a frequent value is a whole range, and a row's number in
    that order less its key's first one is its position: no count by value is shuffled and
    no window is needed. The other columns are counted by (key, value) from the written
    rows, where a key's rows lie together. Filling adds the median some more times, so
    values below it keep their positions, the others move up by the number filled in, and
    the positions between hold the median."""
    x, base = F.col(column).cast("double") + F.lit(0.0), present(df, [key])      # -0.0 and 0.0 are one value
    salted = base.withColumn("_salt", F.monotonically_increasing_id() % 64)
    rows = ordered(salted, [F.col(key), x.asc_nulls_first(), F.col("_salt")], row_partitions(df.sparkSession, base.count()))
    values = numbered(rows, [key, x.alias("_x")], "_number")
    # one row a key, written: the joins know its size; missing values come first
    groups = values.groupBy(key).agg(F.count("_x").alias(GROUP_N), F.count_if(F.col("_x").isNull()).alias("_filled"), F.min("_number").alias("_first"))
    groups = materialize(groups.where(F.col(GROUP_N) > 0), "key-positions")

    def placed(keys: DataFrame) -> DataFrame:
        own = values.where(F.col("_x").isNotNull()).join(keys, key)
        return own.withColumn(POS, F.col("_number") - F.col("_first") - F.col("_filled")).withColumn("_c", F.lit(1))

    own = interpolated(placed(groups), [key], F.col(GROUP_N), F.col(POS), {f"_med_{column}": 0.5})
    others = [c for c in columns if c != column]
    medians = materialize(own.join(quantiles(rows, [key], others, {"_med": 0.5}), key, "full") if others else own, "key-medians")
    medians = medians.select(key, *[f"_med_{c}" for c in columns])
    known = materialize(groups.join(medians.select(key, F.col(f"_med_{column}").alias("_med")), key), "key-positions")
    moved = F.col(POS) + F.when(F.col("_x") < F.col("_med"), F.lit(0)).otherwise(F.col("_filled"))
    q = interpolated(placed(known), [key], F.col(GROUP_N) + F.col("_filled"), moved, probs, F.col("_med"))
    return rows.select(*df.columns), medians, q.withColumnsRenamed({name: f"{name}_{column}" for name in probs})


def approx_quantiles(df: DataFrame, keys: Sequence[str], columns: Sequence[str],
                     probs: Mapping[str, float], accuracy: int = 10000) -> DataFrame:
    """Mergeable-sketch quantiles, for callers who ask for them by name."""
    aggs = [F.percentile_approx(F.col(c).cast("double"), float(p), accuracy).alias(f"{name}_{c}")
            for c in columns for name, p in probs.items()]
    return present(df, keys).groupBy(*keys).agg(*aggs)


def dense_rank_by(df: DataFrame, column: str, ascending: bool = True,
                  out: str = "rank", partition_keys: Sequence[str] = ()) -> DataFrame:
    """Dense rank of ``column`` (optionally inside ``partition_keys``):
    positions of the distinct values, joined back. NULL values get a NULL rank
    (T10). The rank is BIGINT (T23)."""
    vals = df.select(*partition_keys, F.col(column).alias("_v")).where(F.col("_v").isNotNull()).distinct()
    ranks = (with_group_position(vals, list(partition_keys), ["_v"], descending=not ascending)
             .select(*partition_keys, "_v", (F.col(POS) + 1).cast("bigint").alias(out)))
    cond = [df[column] == ranks["_v"]] + [df[k] == ranks[k] for k in partition_keys]
    joined = df.join(ranks, cond, "left")
    return joined.select(*[df[c] for c in df.columns], ranks[out])
