"""Set operations and row-level changes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions.expressions import col_of


def union_all(*frames: DataFrame) -> DataFrame:
    """UNION ALL by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def insert_ignore(old: DataFrame, new: DataFrame, key: Sequence[str], prefer: str) -> DataFrame:
    """U2 (``ON CONFLICT (key) DO NOTHING``): the existing row wins; among new
    rows sharing a key the one with the smallest ``prefer`` value is kept, a missing
    one after all others; rows that tie are told apart by their other columns, so the
    choice doesn't depend on their order. It is a partially aggregated minimum (no
    per-key window). A row without a part of the key conflicts with none, as under a
    unique constraint, and is always inserted."""
    key = list(key)
    rest = [prefer, *[c for c in new.columns if c not in key and c != prefer]]
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    picked = (new.where(whole).groupBy(*key).agg(F.min(F.struct(F.col(prefer).isNull().alias("_missing"), *rest)).alias("_row"))
                 .select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest]))
    fresh = picked.join(old.select(*key), key, "left_anti")
    return union_all(old, fresh.select(*old.columns), new.where(~whole).select(*old.columns))


def append(old: DataFrame, new: DataFrame) -> DataFrame:
    """Insert without a natural key -- nothing is ever ignored."""
    return old.unionByName(new)


def update_where(df: DataFrame, cond: Column, column: str, expr) -> DataFrame:
    """U4: conditional update (NULL-out or scale where ``cond``)."""
    return df.withColumn(column, F.when(cond, col_of(expr) if not isinstance(expr, (int, float, type(None)))
                                        else F.lit(expr)).otherwise(F.col(column)))


def derive_targets(fact: DataFrame, key: Sequence[str], primary: str, fallback: str,
                   out: str = "actual_flow_rate_tpd") -> DataFrame:
    """target = COALESCE(primary, fallback) per key."""
    return fact.select(*key, F.coalesce(F.col(primary), F.col(fallback)).alias(out))


def insert_targets(old: DataFrame, fact: DataFrame, key: Sequence[str], primary: str, fallback: str,
                   out: str = "actual_flow_rate_tpd") -> DataFrame:
    """U5 with its conflict rule: derived targets of ``fact`` are inserted unless
    ``old`` has the key."""
    return insert_ignore(old, derive_targets(fact, key, primary, fallback, out), key, prefer=out)
