"""Order statistics under skew: one key holds a third of the rows and the
input order is shuffled, yet positions, quantiles and ranks are exact."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldmart.operators.positions import approx_quantiles, dense_rank_by, quantiles, with_group_position


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 6000
    keys = np.where(rng.random(n) < 0.34, "hot", rng.choice([f"k{i}" for i in range(40)], n))
    vals = np.round(rng.normal(50, 20, n), 1)        # rounded: many ties
    pdf = pd.DataFrame({"id": np.arange(n), "k": keys, "x": vals})
    df = spark.createDataFrame(pdf).repartition(7)   # shuffle: non-deterministic order
    return pdf, df


def test_positions_are_permutations_per_key(skewed):
    pdf, df = skewed
    pos = with_group_position(df.select("k", "x", "id"), ["k"], ["x", "id"], num_partitions=16).toPandas()
    assert len(pos) == len(pdf)
    for k, g in pos.groupby("k"):
        assert sorted(g._pos) == list(range(len(g)))
        assert (g._n == len(g)).all()
        assert (np.diff(g.sort_values("_pos").x.values) >= 0).all()


def test_quantiles_match_numpy_under_skew(skewed):
    pdf, df = skewed
    q = quantiles(df, ["k"], ["x"], {"q1": 0.25, "med": 0.5, "q3": 0.75}, num_partitions=16).toPandas()
    for _, r in q.iterrows():
        v = pdf[pdf.k == r.k].x.values
        assert r.q1_x == pytest.approx(np.quantile(v, 0.25))
        assert r.med_x == pytest.approx(np.quantile(v, 0.5))
        assert r.q3_x == pytest.approx(np.quantile(v, 0.75))


def test_dense_rank_matches_pandas(skewed):
    pdf, df = skewed
    r = dense_rank_by(df, "x", ascending=False, out="rk").toPandas().sort_values("id")
    expect = pdf.x.rank(method="dense", ascending=False).astype(int).values
    assert (r.rk.values == expect).all()


def test_hot_key_spread_over_partitions(skewed, spark):
    """The range shuffle cuts the hot key into several partitions."""
    _, df = skewed
    pos = df.select("k", "x").repartitionByRange(16, "k", "x").withColumn("_pid", F.spark_partition_id())
    assert pos.where(F.col("k") == "hot").select("_pid").distinct().count() >= 4


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_number_of_ranges_does_not_show(skewed, parts):
    pdf, df = skewed
    q = quantiles(df, ["k"], ["x"], {"q1": 0.25, "q3": 0.75}, num_partitions=parts).toPandas().set_index("k")
    again = quantiles(df, ["k"], ["x"], {"q1": 0.25, "q3": 0.75}, num_partitions=16).toPandas().set_index("k")
    assert (q.sort_index() == again.sort_index()).all().all()          # bit for bit


def test_approx_quantiles_close_to_exact(skewed):
    pdf, df = skewed
    q = approx_quantiles(df, ["k"], ["x"], {"med": 0.5}).toPandas().set_index("k")
    for k, g in pdf.groupby("k"):
        exact = np.quantile(g.x.values, 0.5)
        assert abs(q.loc[k, "med_x"] - exact) <= 0.02 * (g.x.max() - g.x.min()) + 1e-9


def test_positions_exact_without_exchange_reuse(skewed, spark):
    pdf, df = skewed
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        pos = with_group_position(df.select("k", "x", "id"), ["k"], ["x", "id"], num_partitions=16).toPandas()
        q = quantiles(df, ["k"], ["x"], {"med": 0.5}, num_partitions=16).toPandas().set_index("k")
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
    for k, g in pos.groupby("k"):
        assert sorted(g._pos) == list(range(len(g)))
        assert q.loc[k, "med_x"] == pytest.approx(np.quantile(pdf[pdf.k == k].x.values, 0.5))


def test_filled_quantiles_from_one_ordering(spark):
    """Medians and quartiles after the fill equal those of the filled rows."""
    import random

    from fieldmart.operators import clean, positions

    rnd = random.Random(4)
    rows = [(rnd.choice([1, 1, 1, 2, 3, 4, None]), rnd.choice([None, None, 1.0, 2.0, 2.0, 5.0, rnd.gauss(0, 9)]), rnd.choice([None, rnd.random()])) for _ in range(900)]
    rows += [(5, None, 1.0), (6, 4.0, None), (7, 1.0, 1.0), (7, 9.0, None), (7, None, None)]
    df = spark.createDataFrame(rows, "k int, x double, y double")
    probs = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.75, "e": 1.0}
    med, filled = positions.medians_and_filled(df, "k", ["y", "x"], "x", probs)
    want_med = positions.quantiles(df, ["k"], ["y", "x"], {"_med": 0.5})
    want = positions.quantiles(clean.fill_group_median(df, "k", ["x"]), ["k"], ["x"], probs)
    as_rows = lambda f, cols: sorted(map(tuple, f.select(*cols).collect()), key=str)
    assert as_rows(med, want_med.columns) == as_rows(want_med, want_med.columns)
    assert as_rows(filled, want.columns) == as_rows(want, want.columns)


def test_rows_move_once_to_be_cleaned(spark, monkeypatch):
    """Statistics and the test of the rows need one shuffle of the rows; a hot entity and
    a hot value are cut into ranges; the result equals the single steps."""
    import datetime as dt
    import random

    from fieldmart import session
    from fieldmart.operators import clean, positions

    monkeypatch.setattr(session, "ROWS_A_TASK", 20)
    rnd = random.Random(5)
    rows = [(rnd.choice([1, 1, 1, 1, 2, 3, None]), dt.date(2026, 1, 1 + i % 9), rnd.choice([None, 4.0, 4.0, 4.0, 0.0, -0.0, rnd.gauss(4, 3)]), rnd.choice([None, rnd.random()]), 1.0, 5.0) for i in range(700)]
    rows += [(5, dt.date(2026, 1, 1), None, 1.0, 1.0, 1.0), (6, dt.date(2026, 1, 1), 4.0, None, None, 1.0)]
    df = spark.createDataFrame(rows, "entity_id long, day date, flow double, water double, oil double, downtime double")
    got = clean.clean_daily_fact(df)
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    spread = positions.ordered_statistics(df, "entity_id", ["water", "flow"], "flow", {"_q1": 0.25})[0]
    sizes = [r["count"] for r in spread.groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 120          # entity 1 alone has some 400 rows, its value 4.0 some 170
    steps = clean.drop_iqr_outliers(clean.fill_group_median(df, "entity_id", ["water", "flow"]), "entity_id", "flow")
    steps = steps.withColumn("oil", F.coalesce("oil", F.col("flow") * 0.9))
    as_rows = lambda f: sorted(map(tuple, f.select(*df.columns).collect()), key=lambda r: tuple(str(x + 0.0) if isinstance(x, float) else str(x) for x in r))
    assert as_rows(got) == as_rows(steps)


def test_rows_stay_when_medians_are_small(spark, tmp_path):
    """the medians are a written table, so its size, not the rows', decides about
    the join, and the rows aren't shuffled to be filled."""
    from fieldmart.operators import clean

    path = str(tmp_path / "rows")
    df = spark.range(20000).selectExpr("id % 50 AS k", "if(id % 7 = 0, NULL, cast(id % 11 AS double)) AS x", "uuid() AS note")
    df.write.parquet(path)
    df = spark.read.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "50000")
    try:
        filled = clean.fill_group_median(df, "k", ["x"])
        plan = filled._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert filled.count() == 20000 and filled.where("x IS NULL").count() == 0


def test_distinct_days_are_bits(spark):
    """distinct days by stretches of 64, equal to a distinct count: days before 1970,
    repeated and missing ones, and fewer rows than days between the two steps."""
    import datetime as dt
    import random

    from fieldmart.functions.aggregates import distinct_days
    from fieldmart.operators import marts

    rnd, zero = random.Random(3), dt.date(1970, 1, 1)
    rows = [(rnd.choice(["a", "b", None]), zero + dt.timedelta(rnd.randrange(-400, 400)), 1.0) for _ in range(3000)]
    rows += [("c", None, 1.0), ("d", zero - dt.timedelta(1), 1.0), ("d", zero, 1.0), ("d", zero, 2.0), ("e", dt.date(1, 1, 1), 1.0), ("e", dt.date(9999, 12, 31), 1.0)]
    df = spark.createDataFrame(rows, "entity_id string, day date, flow double")
    want = {r[0]: r[1] for r in df.groupBy("entity_id").agg(F.countDistinct("day")).collect()}
    assert {r[0]: r[1] for r in distinct_days(df, ["entity_id"], "day", "n").collect()} == want
    kpi = marts.entity_kpi(df.withColumn("oil", F.lit(1.0)).withColumn("downtime", F.lit(1.0)))
    assert "distinct" not in kpi._jdf.queryExecution().executedPlan().toString()
    assert {r.entity_id: r.days_count for r in kpi.collect()} == {k: n for k, n in want.items() if k is not None}
    assert dict(kpi.dtypes)["days_count"] == "bigint"
