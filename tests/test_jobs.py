"""The four jobs end to end (L3-L7) on the generated source tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

from fieldmart import schemas
from fieldmart.plans import runner
from source_tables import build_sources


@pytest.fixture(scope="module")
def src(spark):
    return build_sources(spark)


@pytest.fixture(autouse=True, scope="module")
def shallow_trees():
    """Depth costs time only; the full depth is tested in test_ml."""
    from fieldmart.operators import ml
    from fieldmart.plans import anomaly, forecast

    before = anomaly.train_failure_model.__defaults__, forecast.train_and_predict.__defaults__
    anomaly.train_failure_model.__defaults__ = (5,)
    forecast.train_and_predict.__defaults__ = (*before[1][:-1], 5)
    yield
    anomaly.train_failure_model.__defaults__, forecast.train_and_predict.__defaults__ = before
    assert ml.MAX_DEPTH == 30


def test_production_job(src):
    m = runner.production_job(src)
    kpi = m["mart_well_kpi"].toPandas()
    assert len(kpi) == 4 and all(schemas.check_mart(df, n) == [] for n, df in m.items())
    assert (kpi.downtime_pct >= 0).all()
    cp = m["clean_production"].toPandas()
    assert cp.water_cut_pct.notna().all() and cp.flow_rate_tpd.notna().all()
    assert cp.downtime_hours.max() <= 24 and cp.oil_tons.notna().all()
    daily = m["mart_production_daily"].toPandas()
    assert abs(daily.total_oil_tons.sum() - kpi.total_oil_tons.sum()) < 1e-6   # A1 and A2 agree
    heat = m["mart_pressure_flow_heatmap"].toPandas()
    assert heat.observations.sum() == m["features_well_daily"].count()           # every feature row binned
    ct = m["clean_telemetry"].toPandas()
    assert ct.temperature_c.between(20, 130).all() and ct.pressure_atm.between(40, 220).all()
    rank = m["mart_well_ranking"].toPandas()
    assert set(rank.well_group) <= {"best", "middle", "worst"}


def test_anomaly_job_flags_spikes_and_labels(src):
    m = runner.anomaly_job_run(src)
    risk = m["mart_pump_risk"].toPandas()
    assert len(risk) == src["pump_sensors"].count()
    assert risk.risk_score.between(0, 1).all()
    labels = risk.groupby("pump_id").failure_within_7d.sum().to_dict()
    assert labels.get("pump_002") == 14 and labels.get("pump_003") == 14   # 12-hourly readings in [t - 7d, t]
    anomalies = m["mart_pump_anomalies"].toPandas()
    assert len(anomalies) > 0 and anomalies.event_time.dt.day.isin([12, 13]).all()
    metrics = m["ml_failure_metrics"].first()
    assert metrics.rows_train + metrics.rows_test == len(risk)


def test_forecast_job(src):
    m = runner.forecast_job(src)
    met = m["ml_flow_metrics"].toPandas()
    assert list(met.model_name) and met.rmse.is_monotonic_increasing
    preds = m["mart_flow_predictions"]
    assert preds.select("model_name").distinct().first().model_name == met.model_name.iloc[0]
    assert preds.where(F.col("absolute_error") < 0).count() == 0


def test_logistics_job(src):
    m = runner.logistics_job(src)
    w = m["mart_delivery_delay_weather"].toPandas()
    assert set(w.weather) == {"snow", "rain", "fog", "clear"}
    assert w.delayed_share.between(0, 1).all()
    assert all(schemas.check_mart(df, n) == [] for n, df in m.items())
    rec = m["mart_route_optimization"].toPandas().sort_values("avg_cost_per_km")
    assert list(rec.recommendation) == sorted(rec.recommendation)


def test_run_all_writes_marts_and_manifest(spark, src, tmp_root):
    url = "jdbc:derby:memory:fieldmart_marts;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    manifest = runner.run_all(spark, src, tmp_root, jdbc_out=(url, props)).toPandas()
    report = spark.read.schema("well_id string, production_date date").json(f"{tmp_root}/artifacts/out_of_range_days")
    assert report.collect() == []   # every day lies in the calendar
    from fieldmart.sources.tables import read_jdbc
    assert read_jdbc(spark, url, "mart_driver_kpi", properties=props).count() == 8
    assert "processed/mart_well_kpi" in set(manifest.dataset)
    assert manifest[manifest.dataset == "raw/production"].rows_count.sum() == src["production"].count()
    assert manifest.object.str.contains("/raw/production/production_date=").sum() == 40 and manifest.object.is_unique
    assert os.path.isdir(f"{tmp_root}/processed/mart_pump_risk")
    back = spark.read.parquet(f"{tmp_root}/processed/mart_production_daily")
    assert back.count() == 40
    files = [f for f in os.listdir(f"{tmp_root}/artifacts/manifest") if f.endswith(".json")]
    first = json.loads(open(f"{tmp_root}/artifacts/manifest/{files[0]}").readline())
    assert "mart_well_kpi" in first["tables"]


def test_sources_over_jdbc_in_process(spark, src):
    """S1/S2 end to end through the in-process Derby driver: write the seven
    tables, read them back split on their serial keys, run the logistics job."""
    from fieldmart.sources import sinks

    url = "jdbc:derby:memory:fieldmart_src;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    try:
        for name, df in src.items():
            sinks.write_jdbc(df, url, name, properties=props)
    except Exception as e:
        pytest.skip(f"derby unavailable: {e}")
    back = runner.load_sources_jdbc(spark, url, props, num_partitions=3)
    for name, df in src.items():
        assert back[name].count() == df.count()
        assert [(f.name, f.dataType) for f in back[name].schema] == [(f.name, f.dataType) for f in df.schema]
    assert back["deliveries"].rdd.getNumPartitions() == 3
    m = runner.logistics_job(back)
    assert m["mart_driver_kpi"].count() == runner.logistics_job(src)["mart_driver_kpi"].count()


def test_runner_command_line(spark, src, tmp_root):
    """The command-line entry over a folder of parquet source tables."""
    for name, df in src.items():
        df.write.parquet(f"{tmp_root}/in/{name}.parquet")
    runner.main(["--parquet", f"{tmp_root}/in", "--out", f"{tmp_root}/out"])
    assert spark.read.parquet(f"{tmp_root}/out/processed/mart_driver_kpi").count() == 8


def test_dashboard_queries_over_the_marts(spark, src):
    """Q1-Q13 by their mart names over the four jobs' outputs."""
    from fieldmart.plans import reports

    frames = {}
    for _, job in runner.JOBS:
        frames.update(job(src))
    frames["pump_sensors"] = src["pump_sensors"]
    out = reports.run_dashboard(spark, frames, limit=10)
    assert set(out) == set(reports.DASHBOARD) | {"q9_kpi_cards"}
    assert out["q2_top_wells"].count() == 4 and out["q7_driver_kpi"].count() == 8
    assert out["q12_risk_before_failure"].count() == 28
    assert out["q12_vibration_before_failure"].where("vibration_mm_s is not null").count() == 28
    assert out["q8_failure_model_metrics"].count() == 1
    cards = out["q9_kpi_cards"].first()
    assert cards.total_oil_tons > 0 and 0 <= cards.downtime_pct <= 100
    f = reports.kpi_cards(frames["features_well_daily"], date_from="2026-01-05", date_to="2026-01-10",
                          regions=["North"])
    feat = frames["features_well_daily"].toPandas()
    feat["production_date"] = feat.production_date.astype(str)
    want = feat[(feat.region == "North") & feat.production_date.between("2026-01-05", "2026-01-10")]
    assert f.first().rows_count == len(want) > 0


def test_jdbc_ranges_of_an_uneven_key(spark):
    """A key with one dense end: no range holds twice the mean rows, none is lost."""
    from fieldmart.sources import sinks
    from fieldmart.sources.tables import balanced_ranges, read_jdbc

    url, props = "jdbc:derby:memory:fieldmart_dense;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.range(3000).select(F.when(F.col("id") < 2900, F.col("id")).when(F.col("id") < 2990, F.col("id") * 1_000_000_007).otherwise(None).alias("k"), "id")
    sinks.write_jdbc(df, url, "dense", properties=props)
    back = read_jdbc(spark, url, "dense", "k", num_partitions=8, properties=props)
    sizes = [r["n"] for r in back.groupBy(F.spark_partition_id()).agg(F.count_if(F.col("k").isNotNull()).alias("n")).collect()]
    assert back.rdd.getNumPartitions() == 8 and max(sizes) <= 2 * 2990 / back.rdd.getNumPartitions()
    assert sorted(r["id"] for r in back.select("id").collect()) == list(range(3000))

    keys = [5] * 50 + list(range(100)) + [-7, 10 ** 15]

    def count(a, width, b):
        found = {}
        for k in keys:
            if a <= k <= b:
                found[(k - a) // width] = found.get((k - a) // width, 0) + 1
        return list(found.items())

    ranges = balanced_ranges(count, min(keys), max(keys), 10)
    assert ranges[0][0] == -7 and ranges[-1][1] == 10 ** 15 and all(b + 1 == c for (_, b), (c, _) in zip(ranges, ranges[1:]))
    held = [sum(a <= k <= b for k in keys) for a, b in ranges]
    assert sum(held) == len(keys) and len(ranges) <= 10 and max(held) <= 51 + 16 + 2


def test_features_meet_the_entities_once(spark, tmp_path):
    """the features take the dimension's columns from the KPI mart, whose rows are the
    producing entities only; no plan of theirs reads all wells. Wells that are missing or
    come twice show as in a direct join."""
    import datetime as dt

    from fieldmart.operators import joins
    from fieldmart.plans.production import build_production_marts
    from fieldmart.session import materialize

    day = lambda i: dt.date(2026, 1, 1 + i % 28)
    production = spark.createDataFrame([(w, day(i), 50.0 + i % 7, 40.0, 5.0, 1.0) for w in (1, 2, 3) for i in range(20)] + [(None, day(0), 1.0, 1.0, 1.0, 1.0)],
                                       "w long, d date, flow double, oil double, water double, down double")
    readings = spark.createDataFrame([(w, dt.datetime(2026, 1, 1 + i % 9, i % 24), float(i), 2.0 * i, 1.0) for w in (1, 2, 9) for i in range(30)],
                                     "w long, ts timestamp_ntz, p double, t double, run double")
    path = str(tmp_path / "all-wells")
    spark.createDataFrame([(1, "a", "f", "r", "on"), (2, "b", "f", "r", "on"), (2, "b", "g", "s", "on"), (9, "c", "g", "s", "on"), (None, "n", "g", "s", "on")],
                          "w long, well_name string, field_name string, region string, status string").write.parquet(path)
    wells, plans = spark.read.parquet(path), {}

    def keep(df, name):
        plans[name] = (df.inputFiles(), df)
        return materialize(df, name)

    made = build_production_marts(production, readings, wells, key="w", day="d", ts="ts", flow="flow", oil="oil", water="water", downtime="down",
                                  measures=["p", "t", "run"], ranges={}, runtime="run", reading_means={"avg_p": "p", "avg_t": "t"}, reading_sums={"run": "run"},
                                  pressure="avg_p", temperature="avg_t", well_columns={c: c for c in ("well_name", "field_name", "region", "status")}, keep=keep)
    assert any("all-wells" in f for f in plans["mart_well_kpi"][0])
    assert not any("all-wells" in f for f in plans["features_well_daily"][0])
    features = made["features_well_daily"]
    direct = joins.enrich(made["clean_production"], wells, "w", ["field_name", "region"])
    shown = ["w", "d", "flow", "field_name", "region"]
    as_rows = lambda f: sorted(map(str, f.select(*shown).collect()))
    assert as_rows(features) == as_rows(direct) and features.count() == 80
    assert features.columns[-2:] == ["field_name", "region"]
