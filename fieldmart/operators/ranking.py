"""Ranking, grouping by rank, sort and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldmart.operators.positions import dense_rank_by, numbered, ordered


def rank_desc(df: DataFrame, column: str, out: str = "rank_by_flow") -> DataFrame:
    """Dense rank, descending, distributed (no single-partition window)."""
    return dense_rank_by(df, column, ascending=False, out=out)


def rank_asc(df: DataFrame, column: str, out: str = "recommendation") -> DataFrame:
    """Dense rank, ascending (1 = cheapest per km)."""
    return dense_rank_by(df, column, ascending=True, out=out)


def rank_group(df: DataFrame, rank: str = "rank_by_flow", n: int = 3, out: str = "well_group") -> DataFrame:
    """Rank <= n -> best; else rank > (row count - n) -> worst; else
    middle. The row count is a scalar subquery over the same frame."""
    total = df.select(F.count(F.lit(1))).scalar()
    return df.withColumn(out, F.when(F.col(rank) <= n, "best")
                              .when(F.col(rank) > total - n, "worst")
                              .otherwise("middle"))


def placed(df: DataFrame, order: Sequence[str], out: str = "place") -> DataFrame:
    """O1-O3: the rows with their place (from 1) in a total order by the given columns
    (``-`` before a name: descending; missing values last), each row's own number in a
    sorted result of any size."""
    by = [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in order]
    return numbered(ordered(df, by), df.columns, out).withColumn(out, F.col(out) + 1)


def top_k(df: DataFrame, by: str, k: int, tie_breaker: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """First k rows by ``by`` with explicit tie-breakers; planned as a
    per-partition top-k followed by one merge (TakeOrderedAndProject)."""
    first = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    return df.orderBy(first, *[F.col(c).asc() for c in tie_breaker]).limit(k)


def argmin(df: DataFrame, metric: str, order_col: str) -> DataFrame:
    """The row with the smallest metric; a tie goes to the first in order."""
    return df.orderBy(F.col(metric).asc_nulls_last(), F.col(order_col).asc()).limit(1)
