"""Hand fixtures for the semantics contract."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from fieldmart.functions import exact
from fieldmart.functions import expressions as E
from fieldmart.operators import anomaly, clean, logistics, marts, positions, ranking, setops
from fieldmart.sources.tables import nan_to_null_all


def test_t1_sum_of_all_missing_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None)], "g string, x double")
    r = exact.aggregate(df, ["g"], sums={"s": "x"}, means={"m": "x"}, counts={"c": "x"}).first()
    assert (r.s, r.m, r.c) == (0.0, None, 0)


def test_t4_nan_becomes_null(spark):
    df = nan_to_null_all(spark.createDataFrame([(float("nan"),), (1.0,)], "x double"))
    assert [r.x for r in df.orderBy("x").collect()] == [None, 1.0]


def test_t5_clip_keeps_missing(spark):
    df = spark.createDataFrame([(None,), (30.0,), (-1.0,)], "x double")
    assert [r.y for r in df.select(E.clip("x", 0, 24).alias("y")).collect()] == [None, 24.0, 0.0]


def test_t6_zero_distance_gives_null(spark):
    df = spark.createDataFrame([(10.0, 0.0, 1.0)], "cost double, distance double, delay double")
    r = logistics.enrich_deliveries(df).first()
    assert r.cost_per_km is None and r.is_delayed == 0


def test_t7_single_reading_z_zero(spark):
    df = spark.createDataFrame([("p", 5.0)], "k string, v double")
    r = anomaly.flag_anomalies(anomaly.group_zscore(df, "k", ["v"]), ["v"]).first()
    assert r.z_v == 0.0 and r.is_anomaly == 0


def test_w3_zscore_invariants(spark):
    rows = [("a", float(i)) for i in range(10)] + [("b", 3.0), ("b", 3.0), (None, 7.0), ("a", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    z = anomaly.group_zscore(df, "k", ["v"]).toPandas()
    a = z[(z.k == "a") & z.v.notna()].z_v
    assert abs(a.mean()) < 1e-12 and abs(a.std(ddof=1) - 1) < 1e-12
    assert (z[z.k == "b"].z_v == 0).all()          # std 0
    assert (z[z.k.isna()].z_v == 0).all()          # missing key (T2)
    assert (z[z.v.isna()].z_v == 0).all()          # missing value


def _bins(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return marts.equal_width_bins(df, {"x": "b"}).orderBy(F.col("x").asc_nulls_last()).collect()


def test_t8_equal_width_bins(spark):
    rows = _bins(spark, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, None])
    assert [r.b_idx for r in rows] == [1, 1, 2, 3, 4, 5, 6, None]
    assert rows[0].b == "(0.994, 2.0]"
    assert rows[-1].b == "nan"


def test_t8_constant_column_middle_bin(spark):
    assert [r.b_idx for r in _bins(spark, [5.0, 5.0])] == [3, 3]


def test_t10_t11_rank_groups(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([9.0, 9.0, 8.0, 7.0])], "id int, f double")
    r = ranking.rank_group(ranking.rank_desc(df, "f")).orderBy("id").collect()
    assert [x.rank_by_flow for x in r] == [1, 1, 2, 3]
    assert {x.well_group for x in r} == {"best"}
    df = spark.createDataFrame([(i, v) for i, v in enumerate([70.0, 60.0, 60.0, 50.0, 50.0, 40.0, 30.0])], "id int, f double")
    r = ranking.rank_group(ranking.rank_desc(df, "f")).orderBy("id").collect()
    assert [x.rank_by_flow for x in r] == [1, 2, 2, 3, 3, 4, 5]
    assert [x.well_group for x in r] == ["best"] * 5 + ["middle", "worst"]


def test_t10_null_rank_is_null(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "id int, f double")
    r = ranking.rank_desc(df, "f").orderBy("id").collect()
    assert r[0].rank_by_flow == 1 and r[1].rank_by_flow is None


def test_t12_quantiles(spark):
    df = spark.createDataFrame([("a", v) for v in [1.0, 2.0, 3.0, 10.0]], "k string, x double")
    r = positions.quantiles(df, ["k"], ["x"], {"q1": 0.25, "med": 0.5, "q3": 0.75}).first()
    assert (r.q1_x, r.med_x, r.q3_x) == (1.75, 2.5, 4.75)


def test_t13_zero_iqr_keeps_group(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 1, 1, 1, 99]], "k string, x double")
    assert clean.drop_iqr_outliers(df, "k", "x").count() == 5


def test_w2_fences(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 10, 100]], "k string, x double")
    kept = sorted(r.x for r in clean.drop_iqr_outliers(df, "k", "x").collect())
    assert kept == [1.0, 2.0, 3.0, 10.0]


def test_w1_median_fill(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 3.0), ("b", None)], "k string, x double")
    r = clean.fill_group_median(df, "k", ["x"]).orderBy("k", F.col("x").asc_nulls_last()).collect()
    assert [(x.k, x.x) for x in r] == [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", None)]


def test_t17_t5_failure_window(spark):
    from fieldmart.operators.joins import label_within

    t = dt.datetime(2026, 2, 14, 9, 0, 0)
    reads = [(1, "p", t), (2, "p", t - dt.timedelta(days=7)), (3, "p", t + dt.timedelta(seconds=1)),
             (4, "p", t - dt.timedelta(days=7, seconds=1)), (5, "q", t)]
    r = spark.createDataFrame(reads, "id int, k string, ts timestamp_ntz")
    f = spark.createDataFrame([("p", t)], "k string, ft timestamp_ntz")
    out = label_within(r, f, "k", "ts", "ft", 7, out="y").orderBy("id").collect()
    assert [x.y for x in out] == [1, 1, 0, 0, 0]


def test_j5_two_failures_one_reading_no_duplicate(spark):
    from fieldmart.operators.joins import label_within

    t = dt.datetime(2026, 3, 1, 12, 0)
    r = spark.createDataFrame([(1, "p", t)], "id int, k string, ts timestamp_ntz")
    f = spark.createDataFrame([("p", t + dt.timedelta(days=1)), ("p", t + dt.timedelta(days=2))],
                              "k string, ft timestamp_ntz")
    out = label_within(r, f, "k", "ts", "ft", 7, out="y").collect()
    assert len(out) == 1 and out[0].y == 1


def test_u2_insert_ignore_keeps_existing(spark):
    old = spark.createDataFrame([(1, "old")], "k int, v string")
    new = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "k int, v string")
    out = setops.insert_ignore(old, new, ["k"], prefer="v").orderBy("k").collect()
    assert [(r.k, r.v) for r in out] == [(1, "old"), (2, "a")]


def test_e1_downtime_pct_and_t21(spark):
    d = spark.createDataFrame([(1, dt.date(2026, 1, 1), 10.0, 9.0, 12.0), (1, dt.date(2026, 1, 2), 20.0, 18.0, 0.0),
                               (2, dt.date(2026, 1, 1), 5.0, None, 6.0)],
                              "entity_id long, day date, flow double, oil double, downtime double")
    k = marts.entity_kpi(d).orderBy("entity_id").collect()
    assert k[0].downtime_pct == pytest.approx(12.0 / 48 * 100) and k[0].days_count == 2
    daily = marts.production_daily(d).orderBy("day").collect()
    assert daily[0].active_wells == 2 and daily[0].total_oil_tons == 9.0


def test_l1_order_median_before_fences_then_fallback(spark):
    rows = [("a", dt.date(2026, 1, i), f, o, 5.0, 1.0) for i, (f, o) in
            enumerate([(10.0, None), (11.0, 9.0), (None, 8.0), (12.0, 7.0), (400.0, 1.0)], start=1)]
    df = spark.createDataFrame(rows, "entity_id string, day date, flow double, oil double, water double, downtime double")
    out = clean.clean_daily_fact(df).orderBy("day").collect()
    assert [r.flow for r in out] == [10.0, 11.0, 11.5, 12.0]      # NULL -> median 11.5, 400 dropped
    assert out[0].oil == pytest.approx(9.0)                         # fallback uses the cleaned flow


def test_j5_matches_brute_force_with_dense_failures(spark):
    """Many failures on one hot entity (several per day, touching intervals)
    against a direct EXISTS check in pandas."""
    import numpy as np
    import pandas as pd
    from fieldmart.operators.joins import label_within

    rng = np.random.default_rng(11)
    base = np.datetime64("2026-01-01T00:00:00")
    n = 3000
    ent = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 6, n))
    ts = base + (rng.integers(0, 60 * 24 * 60, n)).astype("timedelta64[m]")
    reads = pd.DataFrame({"id": np.arange(n), "k": ent, "ts": ts})
    fts = base + (rng.integers(0, 60 * 24 * 60, 200)).astype("timedelta64[m]")
    fails = pd.DataFrame({"k": np.where(rng.random(200) < 0.7, 0, rng.integers(1, 6, 200)), "ft": fts})
    # exact touch: a failure exactly 7 days after another one of entity 0
    fails.loc[len(fails)] = [0, fails.ft.iloc[0] + np.timedelta64(7, "D")]
    h = np.timedelta64(7, "D")
    expect = [int(((fails.k == r.k) & (fails.ft >= r.ts) & (fails.ft - h <= r.ts)).any())
              for r in reads.itertuples()]
    r = spark.createDataFrame(reads).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    f = spark.createDataFrame(fails).withColumn("ft", F.col("ft").cast("timestamp_ntz"))
    got = label_within(r, f, "k", "ts", "ft", 7, out="y").toPandas().sort_values("id")
    assert len(got) == n
    assert list(got.y) == expect


def test_round6_has_no_cap(spark):
    import duckdb

    from fieldmart.plans.oracle_sql import r6

    values = [1e12, 9.3e9, -1e12, 1234567.1234565, 0.1 + 0.2, -2.5e-7, 1e300, 12345678901.123456]
    got = [r.y for r in spark.createDataFrame([(v,) for v in values], "x double").select(E.round6("x").alias("y")).collect()]
    want = [r[0] for r in duckdb.sql("SELECT " + r6("x") + " FROM (SELECT unnest(" + str(values) + "::DOUBLE[]) AS x)").fetchall()]
    assert got == want and got[0] == 1e12 and got[1] == 9.3e9


def test_row_on_the_fence_is_kept(spark):
    """The fence of these flows lies on a value: q3 + 1.5 iqr = 5.8 or a last bit less."""
    df = spark.createDataFrame([("a", v) for v in (1.6, 4.0, 4.2, 5.8)] + [(None, 4.0)], "k string, x double")
    kept = sorted(r.x for r in clean.drop_iqr_outliers(df, "k", "x").collect())
    q1, q3 = 3.4, 4.6
    assert kept == [v for v in (1.6, 4.0, 4.2, 5.8) if round(q1 - 1.5 * (q3 - q1), 6) <= v <= round(q3 + 1.5 * (q3 - q1), 6)]


def test_rows_without_entity_stay_out_of_the_join(spark):
    df = spark.createDataFrame([(None, None), (None, 3.0), ("a", None), ("a", 5.0)], "k string, x double")
    got = sorted(((r.k, r.x) for r in clean.fill_group_median(df, "k", ["x"]).collect()), key=str)
    assert got == sorted([(None, None), (None, 3.0), ("a", 5.0), ("a", 5.0)], key=str)


def test_splits_are_total_and_keep_rows(spark):
    from fieldmart.operators import ml

    df = spark.createDataFrame([(None, 0), (1, 0), (1, 0), (2, 1), (2, 1), (3, None), (4, 0), (5, 0)], "id long, y int")
    assert ml.hash_split(df, ["id"]).where("is_test is null").count() == 0
    out = ml.stratified_split(df, ["id"], "y")
    assert out.count() == 8 and out.where("is_test is null").count() == 0
    assert out.groupBy("id", "y").agg(F.count_distinct("is_test").alias("n")).where("n > 1").count() == 0


def test_sentinel_dates_are_reported_not_expanded(spark):
    from fieldmart.operators import joins

    df = spark.createDataFrame([("a", dt.date(2026, 1, 1)), ("a", dt.date(2026, 1, 3)), ("a", dt.date(9999, 12, 31))], "k string, day date")
    assert [r.day for r in joins.missing_days(df, "k", "day").collect()] == [dt.date(2026, 1, 2)]
    assert [r.day for r in joins.out_of_range_days(df, "k", "day").collect()] == [dt.date(9999, 12, 31)]


def test_missing_days_before_1970_and_after_2099(spark, monkeypatch):
    from fieldmart.plans import queries

    days = [("a", dt.date(1969, 12, 30)), ("a", dt.date(1970, 1, 2)), ("b", dt.date(2099, 12, 31)), ("b", dt.date(2100, 1, 2)), ("c", dt.date(1950, 5, 5))]
    monkeypatch.setattr(queries, "fact_d", lambda spark, sf: spark.createDataFrame(days, "entity_id string, day date"))
    got = sorted((r.entity_id, r.day) for r in queries.QUERIES["missing_days"](spark, "").collect())
    assert got == [("a", dt.date(1969, 12, 31)), ("a", dt.date(1970, 1, 1)), ("b", dt.date(2100, 1, 1))]


def test_filters_reach_the_scan(spark, capsys):
    from oracle_compare import SF_SMALL
    from fieldmart.plans import views

    views.failures(spark, SF_SMALL).explain("formatted")
    text = capsys.readouterr().out
    assert "GreaterThan(value,100.0)" in text and "EqualTo(event_type,error)" in text


def test_sums_do_not_depend_on_partitions(spark):
    from fieldmart.operators import logistics as L

    df = spark.range(2000).select((F.col("id") % 7).alias("driver_id"), (F.sin("id") * 100).alias("volume"), F.cos("id").alias("delay"),
                                  F.lit(1.0).alias("cost_per_km"), F.lit(0).alias("is_delayed"))
    seen = {tuple(sorted(tuple(r) for r in L.driver_kpi(df.repartition(n)).drop("avg_cost_per_km").collect())) for n in (1, 3, 11)}
    assert len(seen) == 1


def test_u2_missing_preference_and_ties_keep_whole_rows(spark):
    old = spark.createDataFrame([(1, "x", 1.0)], "k int, p string, v double")
    new = spark.createDataFrame([(1, "a", 9.0), (2, None, 5.0), (3, None, 7.0), (3, "b", 8.0), (4, "c", 2.0), (4, "c", 1.0), (4, "c", None), (None, "d", 3.0), (None, "d", 3.0)],
                                "k int, p string, v double")
    for parts in (1, 5):
        got = sorted(map(tuple, setops.insert_ignore(old, new.repartition(parts), ["k"], prefer="p").collect()), key=str)
        assert got == sorted([(1, "x", 1.0), (2, None, 5.0), (3, "b", 8.0), (4, "c", None), (None, "d", 3.0), (None, "d", 3.0)], key=str)
