"""Integrity checks: the database constraints of the
reference, re-aimed as operators that return violations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row, one ``nulls_<col>`` count per column, in one pass."""
    cols = list(columns or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulls_{c}") for c in cols])


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count.
    A partially aggregated count, so a hot key costs one row per task."""
    return (df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows_count"))
              .where(F.col("rows_count") > 1))


def orphan_keys(df: DataFrame, fk: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Rows whose foreign key has no dimension row (NULL keys excluded,
    as a nullable FK allows them)."""
    return df.where(F.col(fk).isNotNull()).join(
        dim.select(F.col(dim_key).alias(fk)), fk, "left_anti")


def check_schema(df: DataFrame, expected: StructType, check_nullable: bool = False) -> list[str]:
    """Differences between a frame's schema and the declared one
    (missing, unexpected or mistyped columns). Empty list = conforms."""
    have = {f.name: f for f in df.schema.fields}
    want = {f.name: f for f in expected.fields}
    problems = [f"missing column {n}" for n in want if n not in have]
    problems += [f"unexpected column {n}" for n in have if n not in want]
    for n, f in want.items():
        if n in have:
            if have[n].dataType != f.dataType:
                problems.append(f"column {n}: {have[n].dataType.simpleString()} != {f.dataType.simpleString()}")
            elif check_nullable and have[n].nullable and not f.nullable:
                problems.append(f"column {n} is nullable")
    return problems

