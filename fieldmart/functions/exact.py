"""Sums and means of doubles that don't depend on the order of rows.

A double is an integer times a power of two, so a sum is exact as long as it is kept
in integers. Values are binned by magnitude (``WIDTH`` binary orders a bin); inside a
bin each is the integer ``x * 2^-base``, cut into ``LIMBS`` signed digits of ``DIGIT``
bits, which BIGINT sums add exactly for up to 2^40 values. A group's partial state is
one row per combination of bins that its measures take -- nearly always one, because
the middle bin spans 2^-12 to 2^28 -- and states merge by adding their digits, whatever
wrote them and in whatever order. ``totals`` turns digits into doubles: a bin's sum is
within an ulp or two, bins are added by increasing size, so equal states give equal
doubles. There is no range of values: the bins reach from the smallest subnormal
to the largest double, and each infinity has a bin of its own. Missing values and NaN
(which stands for a missing value in the sources) are ignored; infinities of both
signs have no sum (NULL); a sum beyond the doubles is infinite.

Everything is built-in expressions; the groups' rows are combined before the shuffle."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldmart.functions.expressions import col_of

#: Binary orders of magnitude in a bin, where the middle one begins, bits of a digit
#: and digits of a bin's integer (WIDTH + 53 bits and one to spare).
WIDTH, FIRST, DIGIT, LIMBS = 40, -12, 24, 4
INFINITE = 100
STEP = float(2 ** DIGIT)


def _name(kind: str, measure: str) -> str:
    return f"_{kind}_{measure}"


def _bin(x: str) -> str:
    order = f"cast(floor((log2(abs({x})) - ({FIRST})) / {WIDTH}) as int)"
    return (f"CASE WHEN (abs({x}) >= {2.0 ** FIRST!r}D AND abs({x}) < {2.0 ** (FIRST + WIDTH)!r}D) OR {x} = 0D OR {x} IS NULL THEN 0 "
            f"WHEN {x} = double('Infinity') THEN {INFINITE} WHEN {x} = double('-Infinity') THEN -{INFINITE} ELSE {order} END")


def _half(b: str) -> str:
    """2^(-base / 2) of a bin, whose base is WIDTH * b + FIRST - 54 (even, and at most
    the last bit of the bin's smallest value)."""
    half = (FIRST - 54) // 2
    return f"CASE WHEN {b} = 0 THEN {2.0 ** -half!r}D ELSE pow(2D, -({b} * {WIDTH // 2} + ({half}))) END"


def states(df: DataFrame, keys: Sequence[str], measures: Mapping[str, str | Column], rows: str = "_rows") -> DataFrame:
    """Partial states of ``measures`` (name -> column) per key: bins, digit sums and
    counts of present values, beside the number of rows. A mergeable table. Names are
    plain identifiers; columns may have any name."""
    if not all(m.isidentifier() for m in measures):
        raise ValueError(f"measure names must be identifiers: {list(measures)}")
    x = {m: _name("x", m) for m in measures}
    bins = {m: _name("b", m) for m in measures}
    base = df.select(*keys, *[F.nanvl(col_of(c).cast("double"), F.lit(None).cast("double")).alias(x[m]) for m, c in measures.items()])
    scaled = [f"CASE WHEN abs({b}) = {INFINITE} THEN 1D ELSE {x[m]} * ({_half(b)}) * ({_half(b)}) END AS {x[m]}" for m, b in bins.items()]
    aggs = [f"count(1) AS {rows}"]
    for m, y in x.items():
        whole = [f"rint({y} * {STEP ** -k!r}D)" for k in range(LIMBS)]
        digits = [f"{low} - {STEP!r}D * {high}" for low, high in zip(whole, whole[1:])] + [whole[-1]]
        aggs += [f"sum(cast({d} as bigint)) AS {_name(f's{k}', m)}" for k, d in enumerate(digits)] + [f"count({y}) AS {_name('n', m)}"]
    own, by = _quoted(keys), [*_quoted(keys), *bins.values()]
    return _query(base, [[*own, *x.values(), *[f"{_bin(x[m])} AS {b}" for m, b in bins.items()]], [*by, *scaled], [*by, *aggs]], by)


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def _query(df: DataFrame, selects: Sequence[Sequence[str]], group: Sequence[str], then: Sequence[Sequence[str]] = ()) -> DataFrame:
    """Nested SELECTs over a frame as one statement, so that they are analysed once:
    the last of ``selects`` under GROUP BY ``group``, followed by those of ``then``."""
    view = f"_exact_{uuid.uuid4().hex}"
    text = view
    for k, items in enumerate(selects):
        grouped = f" GROUP BY {', '.join(group)}" if group and k == len(selects) - 1 else ""
        text = f"(SELECT {', '.join(items)} FROM {text}{grouped})"
    for items in then:
        text = f"(SELECT {', '.join(items)} FROM {text})"
    df.createOrReplaceTempView(view)
    try:
        return df.sparkSession.sql(f"SELECT * FROM {text}")
    finally:
        df.sparkSession.catalog.dropTempView(view)


def merge(parts: Sequence[DataFrame], keys: Sequence[str], measures: Sequence[str], rows: str = "_rows") -> DataFrame:
    """One state per key and bins of several state tables."""
    added = [rows, *[_name(f"s{k}", m) for m in measures for k in range(LIMBS)], *[_name("n", m) for m in measures]]
    both = reduce(DataFrame.unionByName, parts)
    return both.groupBy(*keys, *[_name("b", m) for m in measures]).agg(*[F.sum(c).alias(c) for c in added])


def _value(m: str) -> str:
    """A state's sum as a double (NULL without values): its digit sums from the highest
    down. A step that rounds has a result above 2^53, which no lower digit sum (at most
    half a unit for each of 2^40 values) can cancel; so the error is a few ulps."""
    v = f"cast({_name(f's{LIMBS - 1}', m)} as double)"
    for k in range(LIMBS - 2, -1, -1):
        v = f"({v} * {STEP!r}D + {_name(f's{k}', m)})"
    b = _name("b", m)
    half = f"pow(2D, {b} * {WIDTH // 2} + ({(FIRST - 54) // 2}))"
    infinite = f"if({b} > 0, double('Infinity'), double('-Infinity'))"
    return f"CASE WHEN {_name('n', m)} = 0 THEN NULL WHEN abs({b}) = {INFINITE} THEN {infinite} ELSE {v} * {half} * {half} END AS {_name('v', m)}"


def totals(state: DataFrame, keys: Sequence[str], measures: Sequence[str], rows: str = "_rows") -> DataFrame:
    """Per key the sum ``_sum_m`` (NULL without a value) and count ``_n_m`` of each
    measure and the number of rows. The rows of a key are its few bins."""
    own, n = _quoted(keys), [_name("n", m) for m in measures]
    lists = [f"array_sort(collect_list(named_struct('size', abs({v}), 'x', {v})) FILTER (WHERE {v} IS NOT NULL)) AS {v}" for v in (_name("v", m) for m in measures)]
    added = [f"if(size({_name('v', m)}) > 0, nanvl(aggregate({_name('v', m)}, 0D, (t, p) -> t + p.x), NULL), NULL) AS {_name('sum', m)}" for m in measures]
    return _query(state, [[*own, rows, *n, *[_value(m) for m in measures]], [*own, *[f"coalesce(sum({c}), 0L) AS {c}" for c in (rows, *n)], *lists]], own, [[*own, rows, *n, *added]])


def aggregate(df: DataFrame, keys: Sequence[str] = (), *, sums: Mapping[str, str | Column] | None = None, means: Mapping[str, str | Column] | None = None,
              counts: Mapping[str, str | Column] | None = None, rows: str | None = None) -> DataFrame:
    """``groupBy(keys).agg(...)`` with exact sums (0 without a value, T1) and means
    (NULL without one) and counts of present values; output name -> column.
    Without keys: one row. Columns come in the order sums, means, counts, rows."""
    sums, means, counts = sums or {}, means or {}, counts or {}
    own, named, expr = {}, {}, {**{("sum", o): c for o, c in sums.items()}, **{("mean", o): c for o, c in means.items()}}
    for out, c in expr.items():       # one state for a column that is both added and averaged
        shown = c if isinstance(c, str) else str(c)
        named.setdefault(shown, (f"m{len(named)}", c))
        own[out] = named[shown][0]
    measures = dict(named.values())
    present = {f"c{i}": c for i, c in enumerate(counts.values())}
    return finish(states(df, keys, {**measures, **{n: F.when(col_of(c).isNotNull(), F.lit(0.0)) for n, c in present.items()}}), keys,
                  {o: own["sum", o] for o in sums}, {o: own["mean", o] for o in means}, dict(zip(counts, present)), rows)


def finish(state: DataFrame, keys: Sequence[str], sums: Mapping[str, str], means: Mapping[str, str], counts: Mapping[str, str] | None = None,
           rows: str | None = None) -> DataFrame:
    """Sums, means and counts (output name -> measure) and the number of rows of a
    state table."""
    counts = counts or {}
    t = totals(state, keys, list(dict.fromkeys([*sums.values(), *means.values(), *counts.values()])))
    return t.select(*keys, *[F.coalesce(F.col(_name("sum", m)), F.when(F.col(_name("n", m)) == 0, F.lit(0.0))).alias(o) for o, m in sums.items()],
                    *[(F.col(_name("sum", m)) / F.nullif(F.col(_name("n", m)), F.lit(0))).alias(o) for o, m in means.items()],
                    *[F.col(_name("n", m)).alias(o) for o, m in counts.items()], *([F.col("_rows").alias(rows)] if rows else []))
