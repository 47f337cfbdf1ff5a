"""Registered queries on the driver's tables: one per operator group of
SURVEY §7.4. Each takes (spark, sf_dir) and returns a DataFrame whose columns
match the SQL twin in :mod:`fieldmart.plans.oracle_sql`. Plans that need a
written intermediate or a fitted model run its jobs while they are built; the
rest is lazy."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField, StructType

from fieldmart.functions import expressions
from fieldmart.functions.aggregates import distinct_counts, distinct_states, merge_distinct
from fieldmart.operators import clean, history, marts
from fieldmart.plans import views
from fieldmart.session import materialize, materialize_once

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Parameters of the cleaning steps on the driver's tables (fixed values).
READING_RANGES = {"value": (0.5, 1000.0), "k": (2.0, 97.0)}
READING_MEASURES = ("value", "k", "runtime")


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def round6(df: DataFrame) -> DataFrame:
    """Round every double column for comparison."""
    return df.select(*[expressions.round6(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def fact_d(spark, sf):
    """The aggregated source view, written once per session and folder."""
    return materialize_once(spark, "daily_fact", sf, lambda: views.daily_fact(spark, sf))


def readings_r(spark, sf):
    """The readings view (parsed from JSON), written once per session and folder."""
    return materialize_once(spark, "readings", sf, lambda: views.readings(spark, sf))


def cleaned_d(spark, sf):
    """The cleaned tables are written once per session and folder, too: the marts
    read them, as the jobs' marts read theirs."""
    return materialize_once(spark, "clean_d", sf, lambda: clean.clean_daily_fact(fact_d(spark, sf)))


def cleaned_u(spark, sf):
    facts = materialize_once(spark, "user_daily_fact", sf, lambda: views.user_daily_fact(spark, sf))
    return materialize_once(spark, "clean_u", sf, lambda: clean.clean_daily_fact(facts))


def cleaned_r(spark, sf):
    return materialize_once(spark, "clean_r", sf, lambda: clean.clean_readings(readings_r(spark, sf), measures=READING_MEASURES, ranges=READING_RANGES))


def kpi_d(spark, sf):
    return marts.entity_kpi(cleaned_d(spark, sf), views.supplier_entities(spark, sf))


def kpi_mart(spark, sf):
    """The KPI mart as a written table (one row per entity), for queries that
    read it more than once (ranking, scalar row count)."""
    return materialize(kpi_d(spark, sf), "mart_well_kpi")


@register("clean_daily_fact")
def q_clean_daily_fact(spark, sf):
    """L1: W1 W2 E4 E5 P9 on d."""
    return round6(cleaned_d(spark, sf).select("entity_id", "day", "flow", "oil", "water", "downtime"))


@register("clean_daily_fact_range")
def q_clean_daily_fact_range(spark, sf):
    """L1 with the statistics cut into 64 ranges; same result as
    ``clean_daily_fact`` (the number of ranges doesn't show)."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        out = materialize(clean.clean_daily_fact(fact_d(spark, sf)), "clean_daily_fact")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return round6(out.select("entity_id", "day", "flow", "oil", "water", "downtime"))


@register("clean_daily_fact_merged")
def q_clean_daily_fact_merged(spark, sf):
    """L1 kept from run to run: the counts of the days before 1998, then those of the
    later days merged to them; the statistics of both clean all rows."""
    d, path = fact_d(spark, sf), f"{_scratch(spark)}/counts"
    for part, rows in (("before", F.col("day") < "1998-01-01"), ("since", F.col("day") >= "1998-01-01")):
        history.add_counts(d.where(rows), "entity_id", ["water", "flow"], path, part)
    out = history.clean_daily_fact(d, history.read_counts(spark, path))
    return round6(out.select("entity_id", "day", "flow", "oil", "water", "downtime"))


@register("clean_readings_merged")
def q_clean_readings_merged(spark, sf):
    """L2 kept from run to run: a part per type of event, one of them written twice."""
    r, path = readings_r(spark, sf), f"{_scratch(spark)}/counts"
    error = F.coalesce(F.col("event_type") == "error", F.lit(False))
    for part, rows in (("errors", ~error), ("errors", error), ("others", ~error)):
        history.add_counts(r.where(rows), "entity_id", READING_MEASURES, path, part)
    out = history.clean_readings(r, history.read_counts(spark, path), measures=READING_MEASURES, ranges=READING_RANGES)
    return round6(out.select("event_id", "entity_id", "ts", "event_type", "value", "k", "runtime", "day"))


def rebuilt_states(spark, sf):
    """Daily states of cleaned d, stored with wrong values on the first day of each
    month; then the states of those dates alone are written again."""
    d, root, measures = cleaned_d(spark, sf), _scratch(spark), ["flow", "oil", "downtime"]
    wrong = F.dayofmonth("day") == 1
    history.add_daily_states(setops.update_where(d, wrong, "flow", F.col("flow") * 3 + 1), "entity_id", "day", measures, root, "states")
    history.add_daily_states(d.where(wrong), "entity_id", "day", measures, root, "states")
    return history.daily_states(spark, root, "states")


@register("production_daily_merged")
def q_production_daily_merged(spark, sf):
    """A1 from stored states after some dates were rebuilt."""
    return round6(history.production_daily(rebuilt_states(spark, sf)))


@register("entity_kpi_merged")
def q_entity_kpi_merged(spark, sf):
    """A2 J1 E1 from stored states after some dates were rebuilt."""
    return round6(history.entity_kpi(rebuilt_states(spark, sf), views.supplier_entities(spark, sf)))


@register("readings_daily_merged")
def q_readings_daily_merged(spark, sf):
    """A3 from stored states; the rows of one date come later than the others."""
    r, root = cleaned_r(spark, sf), _scratch(spark)
    late = F.dayofmonth("day") == 15
    for rows in (~late, late):
        history.add_daily_states(r.where(rows), "entity_id", "day", READING_MEASURES, root, "states")
    return round6(history.readings_daily(history.daily_states(spark, root, "states"), READING_MEANS, READING_SUMS))


@register("distinct_merged")
def q_distinct_merged(spark, sf):
    """A14 that merges: days per supplier from bitmaps of overlapping parts of lineitem."""
    li = views.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("entity_id"), F.to_date("l_shipdate").alias("day"), "l_linenumber")
    parts = [distinct_states(li.where(rows), ["entity_id"], "day") for rows in ("l_linenumber <= 3", "l_linenumber >= 3")]
    return distinct_counts(merge_distinct(parts, ["entity_id"]), ["entity_id"], "days_count")


@register("fence_ties")
def q_fence_ties(spark, sf):
    """W2 on data whose fences lie on values: tax per cent of lines (0 to 8, with
    the last bits of a product) with fences half an interquartile range out."""
    li = views.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("entity_id"), "l_orderkey", "l_linenumber", (F.col("l_tax") * 100).alias("pct"))
    return round6(clean.drop_iqr_outliers(li, "entity_id", "pct", k=0.5))


@register("clean_readings")
def q_clean_readings(spark, sf):
    """L2: W1 P5 E4 E13 on r."""
    return round6(cleaned_r(spark, sf).select("event_id", "entity_id", "ts", "event_type",
                                              "value", "k", "runtime", "day"))


@register("production_daily")
def q_production_daily(spark, sf):
    """A1 A11-A14 on cleaned d."""
    return round6(marts.production_daily(cleaned_d(spark, sf)))


@register("entity_kpi")
def q_entity_kpi(spark, sf):
    """Flagship (Q2): A2 J1 E1 on cleaned d and supplier entities."""
    return round6(kpi_d(spark, sf).select(
        "entity_id", "avg_flow_rate_tpd", "total_oil_tons", "downtime_hours", "days_count",
        "name", "field", "region", "status", "downtime_pct"))


# --------------------------------------------------------------------------
# production marts on the readings' entities (u, r, customer entities)

from fieldmart.operators import anomaly, joins, logistics, ranking  # noqa: E402

READING_MEANS = {"avg_value": "value", "avg_k": "k"}
READING_SUMS = {"runtime_hours": "runtime"}
ZSCORE_COLUMNS = ("value", "k")
HORIZON_DAYS = 7
TOP_K = 10
# Fixed dashboard filter of Q9.
KPI_FILTER = {"date_from": "2024-01-05", "date_to": "2024-01-25", "regions": ("ASIA", "EUROPE", "AMERICA")}


def readings_per_day(spark, sf):
    return marts.readings_daily(cleaned_r(spark, sf), means=READING_MEANS, sums=READING_SUMS)


def features_u(spark, sf):
    return marts.features_daily(cleaned_u(spark, sf), readings_per_day(spark, sf),
                                views.customer_entities(spark, sf))


def features_mart(spark, sf):
    """The feature table written once (binning reads it twice: min/max, then
    the assignment)."""
    return materialize(features_u(spark, sf), "features_well_daily")


def labelled_readings(spark, sf):
    """W3 + P11 + J5 on r: z-scores, anomaly flag, failure label, and the
    z-score proxy risk (largest |z|) used by the dashboard queries."""
    r = readings_r(spark, sf)
    z = anomaly.flag_anomalies(anomaly.group_zscore(r, "entity_id", ZSCORE_COLUMNS), ZSCORE_COLUMNS)
    lab = joins.label_within(z, views.failures(spark, sf), "entity_id", "ts", "failure_time", HORIZON_DAYS)
    return lab.withColumn("risk_score", F.greatest(*[F.abs(F.col(f"z_{c}")) for c in ZSCORE_COLUMNS]))


def enriched_v(spark, sf):
    return logistics.enrich_deliveries(views.deliveries(spark, sf))


@register("entity_ranking")
def q_entity_ranking(spark, sf):
    """W4 W6 on the entity KPI mart."""
    r = ranking.rank_group(ranking.rank_desc(kpi_mart(spark, sf), "avg_flow_rate_tpd"))
    return round6(r.select("entity_id", "avg_flow_rate_tpd", "rank_by_flow", "well_group"))


@register("entity_ranking_range")
def q_entity_ranking_range(spark, sf):
    """W4 W6 with the dense rank taken in the whole table's one group of cleaned
    rows: many values, ranked over ranges; joined to the entity KPI mart."""
    from fieldmart.operators.positions import dense_rank_by

    r = ranking.rank_group(dense_rank_by(kpi_mart(spark, sf), "avg_flow_rate_tpd", ascending=False, out="rank_by_flow"))
    return round6(r.select("entity_id", "avg_flow_rate_tpd", "rank_by_flow", "well_group"))


@register("readings_daily")
def q_readings_daily(spark, sf):
    """A3 on cleaned r."""
    return round6(readings_per_day(spark, sf))


@register("readings_daily_raw")
def q_readings_daily_raw(spark, sf):
    """A4: per (entity, day) means and sum of the raw readings (no cleaning),
    the forecast's feature table (T19)."""
    return round6(marts.readings_daily(readings_r(spark, sf), means=READING_MEANS, sums=READING_SUMS))


@register("features_daily")
def q_features_daily(spark, sf):
    """Cleaned u LEFT JOIN daily readings, entity field/region."""
    return round6(features_u(spark, sf).select(
        "entity_id", "day", "flow", "oil", "water", "downtime", "avg_value", "avg_k",
        "runtime_hours", "downtime_ratio", "field", "region"))


@register("bin_heatmap")
def q_bin_heatmap(spark, sf):
    """6 x 6 equal-width bins of (avg_value, avg_k) -> mean flow."""
    return round6(marts.bin_heatmap(features_mart(spark, sf), "avg_value", "avg_k", "flow"))


@register("bin_edges")
def q_bin_edges(spark, sf):
    """E16 where values lie on edges (line numbers 1 to 7 in six bins) and on a
    constant column."""
    li = views.table(spark, sf, "lineitem").select("l_linenumber", F.lit(1.0).alias("one"))
    b = marts.equal_width_bins(li, {"l_linenumber": "line_bin", "one": "one_bin"}, 6)
    return b.groupBy("l_linenumber", "line_bin_idx", "line_bin", "one_bin_idx", "one_bin").agg(F.count(F.lit(1)).alias("rows_count"))


@register("group_zscore_flags")
def q_group_zscore_flags(spark, sf):
    """W3 P11 E7 E9-E11 on r."""
    r = readings_r(spark, sf)
    z = anomaly.flag_anomalies(anomaly.group_zscore(r, "entity_id", ZSCORE_COLUMNS), ZSCORE_COLUMNS)
    return round6(z.select("event_id", "entity_id", "ts", "value", "k", "z_value", "z_k", "is_anomaly"))


@register("failure_within_horizon")
def q_failure_within_horizon(spark, sf):
    """Readings labelled by failures in [t, t + 7 days]."""
    lab = joins.label_within(readings_r(spark, sf), views.failures(spark, sf),
                             "entity_id", "ts", "failure_time", HORIZON_DAYS)
    return lab.select("event_id", "entity_id", "ts", "failure_within_7d")


@register("delay_by_category")
def q_delay_by_category(spark, sf):
    """E3 P10 A6 (Q6)."""
    return round6(logistics.delay_by_category(enriched_v(spark, sf)))


@register("cost_by_route")
def q_cost_by_route(spark, sf):
    """A7 (Q10)."""
    return round6(logistics.cost_by_route(enriched_v(spark, sf)))


@register("route_recommendation")
def q_route_recommendation(spark, sf):
    """A7 + W5."""
    return round6(logistics.route_recommendation(materialize(logistics.cost_by_route(enriched_v(spark, sf)), "cost_by_route")))


@register("bad_distance")
def q_bad_distance(spark, sf):
    """Deliveries without a usable distance, per route."""
    return logistics.bad_distance(views.deliveries(spark, sf))


@register("driver_kpi")
def q_driver_kpi(spark, sf):
    """A8 (Q7)."""
    return round6(logistics.driver_kpi(enriched_v(spark, sf)))


@register("top_entities")
def q_top_entities(spark, sf):
    """O4 O5 (Q2 with limit): top 10 entities by mean flow, entity id breaks ties."""
    t = ranking.top_k(kpi_d(spark, sf), "avg_flow_rate_tpd", TOP_K, tie_breaker=["entity_id"])
    return round6(t.select("entity_id", "name", "avg_flow_rate_tpd", "downtime_pct", "total_oil_tons"))


@register("kpi_cards")
def q_kpi_cards(spark, sf):
    """A10 over the whole feature table."""
    return round6(marts.kpi_cards(features_u(spark, sf)))


@register("kpi_cards_filtered")
def q_kpi_cards_filtered(spark, sf):
    """Q9: P12 dashboard filters (dates, regions) then A10."""
    f = marts.dashboard_filter(features_u(spark, sf), date_from=KPI_FILTER["date_from"],
                               date_to=KPI_FILTER["date_to"], regions=KPI_FILTER["regions"])
    return round6(marts.kpi_cards(f))


@register("downtime_summary")
def q_downtime_summary(spark, sf):
    """A20 (Q13): downtime per region from the entity KPI mart."""
    return round6(marts.downtime_summary(kpi_d(spark, sf)))


@register("max_risk_by_entity")
def q_max_risk_by_entity(spark, sf):
    """A9 (Q11) with the z-score proxy as the risk score."""
    lab = labelled_readings(spark, sf)
    return round6(lab.where(F.col("entity_id").isNotNull()).groupBy("entity_id")
                  .agg(F.max("risk_score").alias("max_risk")))


@register("pre_failure_curve")
def q_pre_failure_curve(spark, sf):
    """Readings inside a failure horizon with their risk, and their place by time."""
    lab = round6(labelled_readings(spark, sf).where(F.col("failure_within_7d") == 1)
                 .select("entity_id", "ts", "risk_score", "is_anomaly", "failure_within_7d"))
    return ranking.placed(lab, ["ts", "entity_id", "risk_score"])


@register("pre_failure_vibration")
def q_pre_failure_vibration(spark, sf):
    """Q12 O3 with decision D5: the sensor value (vibration) beside the risk."""
    lab = labelled_readings(spark, sf)
    return ranking.placed(round6(lab.where(F.col("failure_within_7d") == 1).select("entity_id", "ts", F.col("value").alias("vibration"), "risk_score")),
                          ["entity_id", "ts", "vibration", "risk_score"])


# --------------------------------------------------------------------------
# integrity checks, set operations, splits and metrics

from fieldmart.operators import ml, quality, setops  # noqa: E402
from fieldmart.plans import anomaly as anomaly_job  # noqa: E402
from fieldmart.plans import forecast, reports  # noqa: E402
from fieldmart.plans.production import build_production_marts  # noqa: E402
from fieldmart.functions import exact  # noqa: E402
from fieldmart.sources.tables import register_views  # noqa: E402
from fieldmart.session import scratch_path  # noqa: E402
from fieldmart.sources import sinks  # noqa: E402

FORECAST_FEATURES = ("avg_value", "avg_k", "runtime_hours")
# Foreign keys checked on the driver's tables.
ORPHAN_CHECKS = (
    ("lineitem.l_orderkey", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem.l_partkey", "lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem.l_suppkey", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders.o_custkey", "orders", "o_custkey", "customer", "c_custkey"),
    ("events.user_id", "events", "user_id", "customer", "c_custkey"),
)


def labelled_r(spark, sf):
    return joins.label_within(readings_r(spark, sf), views.failures(spark, sf),
                              "entity_id", "ts", "failure_time", HORIZON_DAYS)


def flow_targets(spark, sf):
    return setops.derive_targets(views.user_daily_fact(spark, sf), ["entity_id", "day"], "flow", "oil")


def flow_ds(spark, sf):
    return forecast.flow_dataset(flow_targets(spark, sf), readings_r(spark, sf),
                                 READING_MEANS, READING_SUMS)


@register("null_counts")
def q_null_counts(spark, sf):
    """C1 on the readings (faults injected)."""
    return quality.null_counts(readings_r(spark, sf))


@register("duplicate_keys")
def q_duplicate_keys(spark, sf):
    """(l_orderkey, l_linenumber) is not unique in lineitem."""
    return quality.duplicate_keys(views.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("orphan_keys")
def q_orphan_keys(spark, sf):
    """Rows per foreign key without a dimension row."""
    parts = []
    for name, t, fk, dim, dk in ORPHAN_CHECKS:
        bad = quality.orphan_keys(views.table(spark, sf, t), fk, views.table(spark, sf, dim), dk)
        parts.append(bad.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("check_name"), "violations"))
    return setops.union_all(*parts)


@register("missing_days")
def q_missing_days(spark, sf):
    """C4 + J6: (entity, day) cells missing inside each entity's own span, which
    no calendar bounds."""
    return joins.missing_days(fact_d(spark, sf), "entity_id", "day", first=None, last=None)


def _flag_facts(spark, sf):
    li = views.table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("entity_id"), F.to_date("l_shipdate").alias("day"),
                      F.col("l_returnflag").alias("flag")).agg(
        F.sum("l_quantity").alias("qty"), F.count(F.lit(1)).alias("lines"))


@register("insert_ignore")
def q_insert_ignore(spark, sf):
    """Returned lines ('A', 'R') inserted into the 'N' facts on
    (entity, day); existing rows win, 'A' wins over 'R'."""
    fa = _flag_facts(spark, sf)
    old = fa.where(F.col("flag") == "N")
    new = fa.where(F.col("flag").isin("A", "R"))
    return round6(setops.insert_ignore(old, new, ["entity_id", "day"], prefer="flag"))


@register("conditional_update")
def q_conditional_update(spark, sf):
    """U4: NULL-out and scale updates keyed on the serial id."""
    ev = views.table(spark, sf, "events").select("event_id", "event_type", "value")
    ev = setops.update_where(ev, F.col("event_id") % 97 == 0, "value", None)
    ev = setops.update_where(ev, F.col("event_id") % 173 == 0, "value", F.col("value") * 4)
    return round6(ev)


@register("derive_targets")
def q_derive_targets(spark, sf):
    """target = COALESCE(flow, oil) per (entity, day) of d."""
    return round6(setops.derive_targets(views.daily_fact(spark, sf), ["entity_id", "day"], "flow", "oil"))


@register("insert_targets")
def q_insert_targets(spark, sf):
    """Derived targets inserted into existing ones on (entity, day); a target
    that is there stays. The existing ones are the returned lines' mean prices."""
    old = (views.table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R")
           .select(F.col("l_suppkey").alias("entity_id"), F.to_date("l_shipdate").alias("day"), "l_extendedprice"))
    old = exact.aggregate(old, ["entity_id", "day"], means={"actual_flow_rate_tpd": "l_extendedprice"})
    return round6(setops.insert_targets(old, fact_d(spark, sf), ["entity_id", "day"], "flow", "oil"))


@register("append_rows")
def q_append_rows(spark, sf):
    """Rows without a natural key appended; equal rows stay."""
    ev = views.table(spark, sf, "events").select("user_id", "event_type", "value")
    return round6(setops.append(ev, ev.where(F.col("event_type") == "error")))


@register("union_all")
def q_union_all(spark, sf):
    """Three kinds of spikes stacked with UNION ALL."""
    parts = [views.spikes(spark, sf, t, limit).select(F.col("user_id").alias("entity_id"), F.col("ts").alias("failure_time"),
                                                      F.lit(kind).alias("failure_type"))
             for kind, t, limit in (("error_spike", "error", 100.0), ("purchase_spike", "purchase", 300.0), ("click_spike", "click", 400.0))]
    return setops.union_all(*parts)


@register("hash_split")
def q_hash_split(spark, sf):
    """M2: deterministic 25 % test split on the event id hash."""
    return ml.hash_split(views.table(spark, sf, "events").select("event_id"), ["event_id"])


@register("stratified_hash_split")
def q_stratified_hash_split(spark, sf):
    """M3: exact 25 % per failure label, ordered by the id hash."""
    lab = labelled_r(spark, sf).select("event_id", "failure_within_7d")
    return ml.stratified_split(lab, ["event_id"], "failure_within_7d")


@register("class_weights")
def q_class_weights(spark, sf):
    """M7: balanced weights of the failure label."""
    return round6(ml.class_weights(labelled_r(spark, sf), "failure_within_7d"))


# Two constant-rate predictors of a line's price, compared by RMSE.
PRICE_MODELS = (("rate_1000", 1000.0), ("rate_1500", 1500.0))


@register("regression_metrics")
def q_regression_metrics(spark, sf):
    """MAE/RMSE of fixed predictors; best = smallest RMSE."""
    li = views.table(spark, sf, "lineitem")
    models = F.array(*[F.struct(F.lit(name).alias("model_name"), F.lit(order).alias("model_order"), (F.col("l_quantity") * rate).alias("p"))
                       for order, (name, rate) in enumerate(PRICE_MODELS)])
    scored = li.select("l_extendedprice", F.inline(models))
    m = ml.regression_metrics(scored, "l_extendedprice", "p", by=["model_name", "model_order"])
    best = ranking.argmin(m, "rmse", "model_order").select(F.col("model_order").alias("best_order"))   # one row
    m = m.join(F.broadcast(best), F.col("model_order") == F.col("best_order"), "left")
    return round6(m.select("model_name", "model_order", "mae", "rmse", "rows_count", F.col("best_order").isNotNull().cast("int").alias("is_best")))


@register("classification_metrics")
def q_classification_metrics(spark, sf):
    """Accuracy and ROC-AUC of the z-score risk for the failure label."""
    lab = labelled_readings(spark, sf).select("failure_within_7d", "risk_score", (F.col("risk_score") > 1.0).cast("int").alias("pred"))
    lab = materialize(lab, "labelled")   # read by the accuracy and by the ranks
    auc = ml.roc_auc(lab, "failure_within_7d", "risk_score").select("roc_auc").scalar()
    return round6(ml.accuracy(lab, "failure_within_7d", "pred", rows="rows_count").select("accuracy", auc.alias("roc_auc"), "rows_count"))


@register("linear_fit_one_feature")
def q_linear_fit_one_feature(spark, sf):
    """M4: least-squares line of price on quantity (normal equations)."""
    li = views.table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    model = ml.fit_linear(li, ["l_quantity"], "l_extendedprice").stages[-1]
    n = li.count()
    return round6(spark.createDataFrame(
        [(float(model.coefficients[0]), float(model.intercept), n)],
        "slope double, intercept double, rows_count bigint"))


@register("flow_dataset")
def q_flow_dataset(spark, sf):
    """Targets joined to raw daily reading features."""
    return round6(flow_ds(spark, sf).select("entity_id", "day", "actual_flow_rate_tpd", *FORECAST_FEATURES))


@register("linear_fit_residuals")
def q_linear_fit_residuals(spark, sf):
    """M4 on the flow dataset: per-row residuals at 4 decimals (the twin solves
    the normal equations)."""
    ds = flow_ds(spark, sf)
    model = ml.fit_linear(ds, FORECAST_FEATURES, forecast.TARGET)
    s = ml.score(model, ds, out="predicted")
    return s.select("entity_id", "day", (expressions.round6((F.col(forecast.TARGET) - F.col("predicted")) / 100) * 100).alias("residual"))


#: Tree depth in the registered queries: what they return doesn't depend on it, and
#: levels beyond it cost most of the time (README).
QUERY_DEPTH = 12


def _predictions(spark, sf):
    return forecast.train_and_predict(flow_ds(spark, sf), FORECAST_FEATURES, ["entity_id", "day"], max_depth=QUERY_DEPTH)


def _error_ok(df):
    """1 if the stated error is the distance between actual and prediction."""
    return (F.abs(F.abs(F.col(forecast.TARGET) - F.col("predicted_flow_rate_tpd")) - F.col("absolute_error")) < 1e-9).cast("int")



@register("flow_predictions")
def q_flow_predictions(spark, sf):
    """L4: the best model scores every row. The twin states keys, target, split
    part, and that error and model name are sound; a forest's numbers have no SQL."""
    preds, _ = _predictions(spark, sf)
    return round6(preds.select("entity_id", "day", forecast.TARGET, "is_test", _error_ok(preds).alias("error_ok"),
                               F.col("model_name").isin(*forecast.MODELS).cast("int").alias("model_ok")))


@register("model_metrics")
def q_model_metrics(spark, sf):
    """L4 metrics table (Q8): both models with their row counts; errors sound."""
    preds, metrics = _predictions(spark, sf)
    return _stated(metrics, preds)


def _coarse(c):
    """Numbers of fitted models at 4 decimals: two solvers agree so far."""
    return expressions.round6(F.col(c) / 100) * 100


def _stated(metrics, preds):
    """The linear model's errors as numbers (a forest's have no SQL), and whether errors
    are sound and the smaller RMSE (of both) names the predicting model (M14)."""
    linear = F.col("model_name") == "linear_regression"
    best = metrics.agg(F.min_by("model_name", F.struct("rmse", "model_name")).alias("m")).scalar()
    used = preds.agg(F.min("model_name")).scalar()
    return metrics.select("model_name", F.when(linear, _coarse("mae")).alias("mae"), F.when(linear, _coarse("rmse")).alias("rmse"), "rows_train", "rows_test",
                          ((F.col("mae") >= 0) & (F.col("mae") <= F.col("rmse") + 1e-9)).cast("int").alias("errors_ok"), (best == used).cast("int").alias("best_ok"))


@register("tree_leaf_means")
def q_tree_leaf_means(spark, sf):
    """M5 M8: one regression tree on the flow dataset. Its prediction less the mean
    target of the row's leaf, and the leaf's rows up to the three it must hold."""
    ds = materialize(flow_ds(spark, sf), "flow_dataset")
    t = ml.leaf_table(ml.fit_tree(ds, FORECAST_FEATURES, forecast.TARGET, classes=False, max_depth=QUERY_DEPTH), ds, forecast.TARGET)
    return round6(t.select("entity_id", "day", (F.col("told") - F.col("leaf_mean")).alias("from_leaf_mean"), F.least("leaf_rows", F.lit(3)).alias("leaf_rows")))


@register("tree_leaf_shares")
def q_tree_leaf_shares(spark, sf):
    """M6 M7 M9: one weighted classification tree on the labelled readings. Its risk
    less the weighted share of failures in the row's leaf, and the leaf's rows up to 3."""
    lab = labelled_readings(spark, sf).select("event_id", *[F.col(f"z_{c}") for c in ZSCORE_COLUMNS], "is_anomaly", "failure_within_7d")
    lab = materialize(lab, "labelled_z")
    rows = lab.join(F.broadcast(ml.class_weights(lab, "failure_within_7d").select("failure_within_7d", "w")), "failure_within_7d")  # one row per class
    model = ml.fit_tree(rows, [*[f"z_{c}" for c in ZSCORE_COLUMNS], "is_anomaly"], "failure_within_7d", classes=True, weight="w", max_depth=QUERY_DEPTH)
    t = ml.leaf_table(model, rows, "failure_within_7d", weight="w")
    return round6(t.select("event_id", (F.col("told") - F.col("leaf_mean")).alias("from_leaf_share"), F.least("leaf_rows", F.lit(3)).alias("leaf_rows")))


def _risk(spark, sf):
    lab = anomaly_job.add_zscores_and_labels(readings_r(spark, sf), views.failures(spark, sf),
                                             ZSCORE_COLUMNS)
    return anomaly_job.train_failure_model(lab, ZSCORE_COLUMNS, ["event_id"], max_depth=QUERY_DEPTH)


def _risk_ok():
    return F.col("risk_score").between(0.0, 1.0).cast("int").alias("risk_ok")


@register("failure_risk")
def q_failure_risk(spark, sf):
    """A risk score in [0, 1] for every reading with all features, with
    its label and flag."""
    risk, _ = _risk(spark, sf)
    out = anomaly_job.risk_outputs(risk, sensor_cols=ZSCORE_COLUMNS)["mart_pump_risk"]
    return out.select("entity_id", "ts", "failure_within_7d", "is_anomaly", "event_date", _risk_ok())


@register("pump_anomalies")
def q_pump_anomalies(spark, sf):
    """Anomalous readings with sensors, label and a risk in [0, 1]."""
    risk, _ = _risk(spark, sf)
    out = anomaly_job.risk_outputs(risk, sensor_cols=ZSCORE_COLUMNS)["mart_pump_anomalies"]
    return round6(out.select("entity_id", "ts", *ZSCORE_COLUMNS, "is_anomaly", "failure_within_7d", "event_date", _risk_ok()))


# --------------------------------------------------------------------------
# sinks: each writes into the run's scratch (deleted with its tables) and reads back

def _scratch(spark):
    import uuid

    return scratch_path(spark, "tables", spark.sparkContext.applicationId, f"sink-{uuid.uuid4().hex}")


def _per_day(df, day):
    return _cents(exact.aggregate(df, [day], sums={"total_price": "o_totalprice"}, rows="rows_count"))


def _cents(df):
    """Large sums of prices compared at two decimals."""
    return df.withColumn("total_price", F.round("total_price", 2))


@register("sink_table_formats")
def q_sink_table_formats(spark, sf):
    """The orders written as parquet and as csv, replaced by themselves, and kept
    through a replacement that fails half way."""
    root, parts = _scratch(spark), []
    orders = views.table(spark, sf, "orders").select("o_orderstatus", "o_totalprice")
    for fmt in sinks.SUPPORTED_FORMATS:
        path = f"{root}/{fmt}"
        sinks.write_table(orders, path, fmt)
        sinks.write_table(sinks.read_mart(spark, path, fmt), path, fmt)
        broken = orders.withColumn("o_totalprice", F.when(F.col("o_orderstatus") == "F", F.raise_error(F.lit("half way"))).otherwise(F.col("o_totalprice")))
        try:
            sinks.write_table(broken, path, fmt)
        except Exception as e:  # the failing row's own error
            if "half way" not in str(e):
                raise
        back = sinks.read_mart(spark, path, fmt)
        parts.append(exact.aggregate(back, ["o_orderstatus"], sums={"total_price": "o_totalprice"}, rows="rows_count").withColumn("format", F.lit(fmt)))
    return _cents(setops.union_all(*parts))


@register("sink_unpartitioned")
def q_sink_unpartitioned(spark, sf):
    """No partition column, or one that isn't there: one plain dataset."""
    root = _scratch(spark)
    orders = views.table(spark, sf, "orders")
    parts = [sinks.export_partitioned(orders, root, f"raw/orders{i}", key).groupBy("dataset", "partition_value").agg(F.sum("rows_count").alias("rows_count"))
             for i, key in enumerate((None, "no_such_column"))]
    return setops.union_all(*parts)


@register("sink_empty")
def q_sink_empty(spark, sf):
    """An empty frame writes nothing and keeps what was there."""
    root = _scratch(spark)
    orders = views.table(spark, sf, "orders").select("o_orderdate", "o_totalprice")
    sinks.export_partitioned(orders, root, "raw/orders", "o_orderdate")
    listed = sinks.export_partitioned(orders.where("false"), root, "raw/orders", "o_orderdate")
    return sinks.read_export(spark, f"{root}/raw/orders").agg(F.count(F.lit(1)).alias("rows_kept"), listed.select(F.count(F.lit(1))).scalar().alias("objects_listed"))


@register("sink_raw_snapshots")
def q_sink_raw_snapshots(spark, sf):
    """Several frames exported at once, each by its own date key or none."""
    r = readings_r(spark, sf).withColumn("event_date", F.to_date("ts"))
    d = fact_d(spark, sf).withColumnRenamed("day", "production_date")
    manifest = sinks.export_marts({"telemetry": r, "production": d, "region": views.table(spark, sf, "region")}, _scratch(spark), prefix="raw")
    return manifest.groupBy("dataset", "partition_value").agg(F.sum("rows_count").alias("rows_count"))


@register("sink_manifest")
def q_sink_manifest(spark, sf):
    """The manifest lists every written object once; rows by day from it."""
    root = _scratch(spark)
    orders = views.table(spark, sf, "orders")
    sinks.write_manifest(sinks.export_partitioned(orders, root, "raw/orders", "o_orderdate"), f"{root}/artifacts/manifest", ["orders"])
    back = spark.read.json(f"{root}/artifacts/manifest")
    files = sinks.read_export(spark, f"{root}/raw/orders").select(F.col("_metadata.file_path").alias("object")).distinct()
    listed = back.join(files, "object", "left_semi").where(F.col("created_at").isNotNull() & F.array_contains("tables", "orders"))
    return listed.groupBy(F.to_date("partition_value").alias("o_orderdate")).agg(F.sum("rows_count").alias("rows_count"))


@register("sink_report")
def q_sink_report(spark, sf):
    """Metrics written as JSON records and read back."""
    path = f"{_scratch(spark)}/report"
    sinks.write_report(QUERIES["regression_metrics"](spark, sf), path)
    return spark.read.json(path).select("model_name", "mae", "rmse", "rows_count")


@register("sink_statements")
def q_sink_statements(spark, sf):
    """Statements run in order, blank ones skipped; the last one reads what
    the others made. A list that fails in its middle leaves the views as they were."""
    views.table(spark, sf, "orders").createOrReplaceTempView("s13_all")
    sinks.execute_sql(spark, ["CREATE OR REPLACE TEMP VIEW s13_orders AS SELECT * FROM s13_all"])
    try:
        sinks.execute_sql(spark, ["CREATE OR REPLACE TEMP VIEW s13_orders AS SELECT * FROM s13_all WHERE false", "SELECT * FROM s13_no_such_view"])
    except AnalysisException:
        pass
    out = sinks.execute_sql(spark, ["CREATE OR REPLACE TEMP VIEW s13_big AS SELECT * FROM s13_orders WHERE o_totalprice > 100000", "  ", "",
                                    "CREATE OR REPLACE TEMP VIEW s13_open AS SELECT * FROM s13_big WHERE o_orderstatus = 'O'",
                                    "SELECT o_orderpriority, count(*) AS rows_count FROM s13_open GROUP BY o_orderpriority"])
    return out[-1]


@register("export_round_trip")
def q_export_round_trip(spark, sf):
    """Orders exported by order date into the shared folder, read
    back (partition column typed date, T14), counted per date."""
    root = _scratch(spark)
    orders = views.table(spark, sf, "orders")
    sinks.export_partitioned(orders, root, "raw/orders", "o_orderdate")
    return _per_day(sinks.read_export(spark, f"{root}/raw/orders"), "o_orderdate")


# --------------------------------------------------------------------------
# Dashboard and notebook SELECTs as SQL text over the marts

# The dashboard's sort orders (O1-O3), with the other columns to part ties; - is descending.
PLACES = {
    "sql_q1_daily_oil": ["production_date"],
    "sql_q2_well_kpi": ["-avg_flow_rate_tpd", "well_name"],
    "sql_q5_anomalies": ["event_time", "pump_id", "vibration_mm_s", "temperature_c"],
    "sql_q6_delay_weather": ["-avg_delay_hours", "weather"],
    "sql_q7_driver_kpi": ["delayed_share", "avg_cost_per_km", "driver_id"],
    "sql_q10_cost_distance": ["route"],
}

# Key -> (dashboard query of ``reports``, names here by the mart's names).
DASHBOARD_SQL = {
    "sql_q1_daily_oil": ("q1_production_over_time", {"production_date": "day"}),
    "sql_q2_well_kpi": ("q2_top_wells", {"well_name": "name", "well_id": "entity_id"}),
    "sql_q3_heatmap": ("q3_pressure_temperature_heatmap", {}),
    "sql_q5_anomalies": ("q5_anomalies_over_time", {"event_time": "ts", "pump_id": "entity_id", "vibration_mm_s": "value", "temperature_c": "k",
                                                   "current_a": "z_value", "rpm": "z_k"}),
    "sql_q6_delay_weather": ("q6_delay_by_weather", {"weather": "category"}),
    "sql_q7_driver_kpi": ("q7_driver_kpi", {}),
    "sql_q10_cost_distance": ("q10_cost_vs_distance", {}),
}


def named_like(df, names):
    """The frame under the marts' own column names."""
    return df.withColumnsRenamed({own: name for name, own in names.items()})


def _dashboard_mart(spark, sf, name):
    if name == "sql_q1_daily_oil":
        return "mart_production_daily", marts.production_daily(cleaned_d(spark, sf))
    if name == "sql_q2_well_kpi":
        return "mart_well_kpi", kpi_d(spark, sf)
    if name == "sql_q3_heatmap":
        return "mart_pressure_flow_heatmap", marts.bin_heatmap(features_mart(spark, sf), "avg_value", "avg_k", "flow")
    if name == "sql_q5_anomalies":
        return "mart_pump_anomalies", labelled_readings(spark, sf).where("is_anomaly = 1")
    made = logistics.logistics_marts(views.deliveries(spark, sf))
    mart = {"sql_q6_delay_weather": "mart_delivery_delay_weather", "sql_q7_driver_kpi": "mart_driver_kpi", "sql_q10_cost_distance": "mart_delivery_cost_distance"}[name]
    return mart, made[mart]


def _sql_query(name):
    query, names = DASHBOARD_SQL[name]

    def run(spark, sf):
        mart, frame = _dashboard_mart(spark, sf, name)
        register_views(spark, {mart: named_like(frame, names)})
        out = round6(sinks.read_sql(spark, reports.DASHBOARD[query]))
        return ranking.placed(out, PLACES[name]) if name in PLACES else out
    run.__doc__ = f"S11: {reports.DASHBOARD[query]}"
    return run


for _name in DASHBOARD_SQL:
    QUERIES[_name] = _sql_query(_name)


@register("sql_q4_predictions")
def q_sql_q4_predictions(spark, sf):
    """Actual and predicted flow and the error over time, of the linear
    model (its numbers have SQL: the normal equations of the training part)."""
    preds, _ = forecast.train_and_predict(flow_ds(spark, sf), FORECAST_FEATURES, ["entity_id", "day"], models=["linear_regression"])
    register_views(spark, {"mart_flow_predictions": named_like(preds, {"target_date": "day", "well_id": "entity_id"})})
    out = sinks.read_sql(spark, reports.DASHBOARD["q4_actual_vs_predicted"])
    out = out.withColumn("actual_flow_rate_tpd", expressions.round6("actual_flow_rate_tpd"))
    return ranking.placed(out.withColumns({c: _coarse(c) for c in ("predicted_flow_rate_tpd", "absolute_error")}), ["target_date", "well_id"])


@register("sql_q8_model_metrics")
def q_sql_q8_model_metrics(spark, sf):
    """Model metrics ordered by RMSE."""
    preds, metrics = _predictions(spark, sf)
    register_views(spark, {"ml_flow_metrics": metrics})
    return _stated(sinks.read_sql(spark, reports.DASHBOARD["q8_model_metrics"]), preds)


@register("production_marts")
def q_production_marts(spark, sf):
    """L3: the whole production job with its cleaning, under the marts' own names; rows
    of each mart and C5's findings against a schema that lacks one column of it."""
    d = fact_d(spark, sf).withColumn("production_date", F.col("day"))
    t = readings_r(spark, sf).withColumnRenamed("ts", "event_time")
    wells = views.supplier_entities(spark, sf).unionByName(views.customer_entities(spark, sf)).dropDuplicates(["entity_id"])
    made = build_production_marts(
        d.drop("day"), t, wells, key="entity_id", day="production_date", ts="event_time", flow="flow", oil="oil", water="water", downtime="downtime",
        measures=READING_MEASURES, ranges=READING_RANGES, runtime="runtime", reading_means=READING_MEANS, reading_sums=READING_SUMS, pressure="avg_value",
        temperature="avg_k", well_columns={"name": "well_name", "field": "field_name", "region": "region", "status": "status"}, keep=materialize)
    parts = []
    for name, df in made.items():
        declared = StructType([f for f in df.schema.fields if f.name not in ("entity_id", "pressure_bin_idx")] + [StructField("no_such_column", DoubleType())])
        found = quality.check_schema(df, df.schema) + quality.check_schema(df, declared)
        first = "pressure_bin_idx" if "pressure_bin_idx" in df.columns else "entity_id"
        parts.append(df.agg(F.lit(name).alias("mart"), F.count(F.lit(1)).alias("rows_count"),
                            F.lit(found == ["missing column no_such_column"] + [f"unexpected column {first}"] * (first in df.columns)).cast("int").alias("schema_ok")))
    return setops.union_all(*parts)


@register("sql_q8_failure_metrics")
def q_sql_q8_failure_metrics(spark, sf):
    """S11 Q8 for the failure model."""
    _, metrics = _risk(spark, sf)
    register_views(spark, {"ml_failure_metrics": metrics})
    out = sinks.read_sql(spark, reports.DASHBOARD["q8_failure_model_metrics"])
    return out.select("model_name", "rows_train", "rows_test", F.col("accuracy").between(0, 1).cast("int").alias("accuracy_ok"),
                      F.col("roc_auc").between(0, 1).cast("int").alias("auc_ok"))
