"""Scalar column expressions.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "round6", "clip", "safe_div", "ratio_pct", "threshold_flag", "any_abs_over", "key_hash", 
    "abs_error", "in_range", "fill_from",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _floor(x: Column) -> Column:
    """Floor as a double; from 2^53 on, doubles have no fraction (and BIGINT
    would cap them)."""
    return F.when(F.abs(x) < F.lit(2.0 ** 53), F.floor(x).cast("double")).otherwise(x)


def round6(c) -> Column:
    """Round to 6 decimals, half up, after snapping to 9: results that differ
    only in the last bits of a double round alike (T12)."""
    nanos = _floor(col_of(c) * F.lit(1e9) + F.lit(0.5))
    return _floor(nanos / F.lit(1000.0) + F.lit(0.5)) / F.lit(1e6)


def clip(c, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]; a missing value stays missing
    (``greatest``/``least`` would turn NULL into a bound)."""
    c = col_of(c)
    return F.when(c < lo, F.lit(lo)).when(c > hi, F.lit(hi)).otherwise(c)


def safe_div(a, b) -> Column:
    """Division that yields NULL for a zero or missing divisor."""
    return F.try_divide(col_of(a), col_of(b))


def ratio_pct(hours, days, hours_per_day: float = 24.0) -> Column:
    """Downtime % = hours / (days * 24) * 100."""
    return safe_div(col_of(hours), col_of(days) * F.lit(hours_per_day)) * F.lit(100.0)


def threshold_flag(c, limit: float) -> Column:
    """P10: 1 if value > limit, else 0 (missing -> 0)."""
    return F.coalesce((col_of(c) > F.lit(limit)).cast("int"), F.lit(0))


def any_abs_over(cols, limit: float) -> Column:
    """1 if any |x| > limit over the columns, else 0 (missing -> no)."""
    cond = None
    for c in cols:
        term = F.coalesce(F.abs(col_of(c)) > F.lit(limit), F.lit(False))
        cond = term if cond is None else (cond | term)
    return cond.cast("int")


def key_hash(*cols) -> Column:
    """Deterministic 32-bit key hash: the first 8 hex digits of
    md5(c1 || '|' || c2 ...) read as an integer. DuckDB states the same value as
    ('0x' || substr(md5(...), 1, 8))::BIGINT."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("|"))
        parts.append(col_of(c).cast("string"))
    text = F.concat(*parts) if len(parts) > 1 else parts[0]
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def abs_error(a, b) -> Column:
    """E6."""
    return F.abs(col_of(a) - col_of(b))


def in_range(c, lo: float, hi: float) -> Column:
    """P5: inclusive range test; a missing value fails (row dropped by filter)."""
    return F.coalesce(col_of(c).between(lo, hi), F.lit(False))


def fill_from(c, other) -> Column:
    """Fill missing from another expression."""
    return F.coalesce(col_of(c), col_of(other))
