"""Aggregate helpers with the reference's missing-value rules.
Sums and means (A11, A12) are in :mod:`fieldmart.functions.exact`."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions.expressions import col_of

__all__ = ["count_nonnull", "nunique", "distinct_days", "rows", "distinct_states", "merge_distinct", "distinct_counts"]


def count_nonnull(c) -> Column:
    """A13."""
    return F.count(col_of(c))


def nunique(c, approx: bool = False) -> Column:
    """Exact distinct count; ``approx=True`` uses HyperLogLog++ (bounded memory)."""
    return F.approx_count_distinct(col_of(c)) if approx else F.countDistinct(col_of(c))


def distinct_days(df: DataFrame, keys: Sequence[str], day: str, out: str) -> DataFrame:
    """A14 of a date column, one row per key. Sixty-four neighbouring days are the bits of
    one BIGINT, so a task sends a row for each such stretch of a key, not for each of its
    days. Missing dates don't count."""
    number = F.unix_date(day)
    bits = df.select(*keys, F.shiftright(number, 6).alias("_stretch"), F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(63)).alias("_bit"))
    stretches = bits.groupBy(*keys, "_stretch").agg(F.bit_or("_bit").alias("_bits"))
    return stretches.groupBy(*keys).agg(F.coalesce(F.sum(F.bit_count("_bits")), F.lit(0)).cast("bigint").alias(out))


def rows() -> Column:
    """A19."""
    return F.count(F.lit(1))


def distinct_states(df: DataFrame, keys: Sequence[str], column: str, out: str = "bits") -> DataFrame:
    """A14 as a mergeable table: per key and bucket of 32,768 neighbouring ids a bitmap
    of the ids that occur. ``column`` is an integer or a date (its day number); missing
    values don't count. Dense ids need one bucket for 32,768 of them, 4 KB."""
    kind = dict(df.dtypes)[column]
    if kind not in ("date", "bigint", "int", "smallint", "tinyint"):
        raise ValueError(f"{column} is {kind}: number its values first")
    number = F.unix_date(column) if kind == "date" else F.col(column)
    base = df.select(*keys, number.cast("bigint").alias("_id")).where(F.col("_id").isNotNull())
    return (base.groupBy(*keys, F.bitmap_bucket_number("_id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias(out)))


def merge_distinct(parts: Sequence[DataFrame], keys: Sequence[str], out: str = "bits") -> DataFrame:
    """One bitmap per key and bucket of several such tables, which may overlap."""
    return reduce(DataFrame.unionByName, parts).groupBy(*keys, "bucket").agg(F.bitmap_or_agg(out).alias(out))


def distinct_counts(state: DataFrame, keys: Sequence[str], count: str, out: str = "bits") -> DataFrame:
    """The distinct counts of a merged state, one row per key."""
    return state.groupBy(*keys).agg(F.sum(F.bitmap_count(out)).alias(count))
