"""Property-based checks against the single-machine semantics (pandas /
numpy), on random small inputs with ties, NULLs and skewed keys."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fieldmart.operators import marts
from fieldmart.operators.positions import dense_rank_by, quantiles

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]),
                          st.one_of(st.none(), st.integers(-50, 50).map(lambda v: v / 4.0))),
                min_size=1, max_size=60)


@settings(**SETTINGS)
@given(rows)
def test_quantiles_equal_numpy(spark, data):
    pdf = pd.DataFrame(data, columns=["k", "x"])
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "k string, x double")
    got = quantiles(df, ["k"], ["x"], {"q1": 0.25, "med": 0.5, "q3": 0.75}).toPandas()
    got = got.set_index("k")
    for k, g in pdf.dropna(subset=["k"]).groupby("k"):
        v = g.x.dropna().values
        if len(v) == 0:
            assert k not in got.index or pd.isna(got.loc[k, "med_x"])
            continue
        for name, p in (("q1", 0.25), ("med", 0.5), ("q3", 0.75)):
            assert got.loc[k, f"{name}_x"] == pytest.approx(np.quantile(v, p))


@settings(**SETTINGS)
@given(st.lists(st.one_of(st.none(), st.integers(0, 9).map(float)), min_size=1, max_size=40), st.booleans())
def test_dense_rank_equals_pandas(spark, values, ascending):
    pdf = pd.DataFrame({"id": range(len(values)), "v": values})
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double")
    got = dense_rank_by(df, "v", ascending=ascending, out="r").toPandas().sort_values("id")
    want = pdf.v.rank(method="dense", ascending=ascending)
    for g, w in zip(got.r, want):
        assert (g is None or (isinstance(g, float) and math.isnan(g))) if pd.isna(w) else g == int(w)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.one_of(st.lists(st.integers(-1000, 1000).map(lambda v: v / 8.0), min_size=1, max_size=50),
                 st.lists(st.integers(-40, 40).map(lambda v: v / 10.0), min_size=1, max_size=12),
                 st.tuples(st.sampled_from([0.0, 0.5, 1.0, 2.0, 3.0, 16.0, -7.5]), st.integers(1, 4)).map(lambda t: [t[0]] * t[1])))
def test_equal_width_bins_equal_pandas_cut(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, x double")
    got = marts.equal_width_bins(df, {"x": "b"}).toPandas().sort_values("id")
    want = pd.cut(pd.Series(values), bins=6, labels=False) + 1
    assert list(got.b_idx) == list(want)


def test_infinite_values_are_rejected(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),)], "x double")
    with pytest.raises(Exception, match="infinite"):
        marts.equal_width_bins(df, {"x": "b"}).collect()
