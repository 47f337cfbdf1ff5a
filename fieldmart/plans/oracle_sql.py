"""DuckDB SQL twins of the registered queries (driver tables as views).

The view CTEs restate FIXTURES.md §3 in SQL; each query's SQL restates the
operator contract of SURVEY §2 directly (GROUP BY, window, EXISTS ...), so
it checks the Spark plan rather than copying it. Doubles are rounded to 6
decimals on both sides (SURVEY T12).
"""

from __future__ import annotations

# Fault moduli and the key hash are those of FIXTURES.md §3.
HASH = "('0x' || substr(md5(CAST(entity_id AS VARCHAR) || '|' || CAST(day AS VARCHAR)), 1, 8))::BIGINT"

D_CTE = f"""
d0 AS (
  SELECT l_suppkey AS entity_id, CAST(l_shipdate AS DATE) AS day,
         avg(l_extendedprice) AS flow, sum(l_quantity) AS oil,
         avg(l_discount) * 100 AS water, sum(l_tax) * 100 AS downtime
  FROM lineitem GROUP BY 1, 2),
dh AS (SELECT *, {HASH} AS h FROM d0),
d AS (
  SELECT entity_id, day,
         CASE WHEN h % 101 = 0 THEN NULL WHEN h % 173 = 0 THEN flow * 4 ELSE flow END AS flow,
         CASE WHEN h % 103 = 0 THEN NULL ELSE oil END AS oil,
         CASE WHEN h % 97 = 0 THEN NULL ELSE water END AS water,
         downtime
  FROM dh)"""

R_CTE = """
r AS (
  SELECT event_id, user_id AS entity_id, ts, event_type,
         CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 173 = 0 THEN value * 4 ELSE value END AS value,
         CASE WHEN event_id % 151 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k,
         CASE WHEN event_id % 151 = 0 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END / 4 AS runtime
  FROM events)"""

U_CTE = R_CTE + """,
u AS (
  SELECT entity_id, CAST(ts AS DATE) AS day, avg(value) AS flow, sum(value) AS oil, avg(k) AS water,
         coalesce(sum(CASE WHEN event_type = 'error' THEN runtime END), 0.0) AS downtime
  FROM r GROUP BY 1, 2)"""

E_SUPP_CTE = """
es AS (
  SELECT s_suppkey AS entity_id, s_name AS name, n_name AS field, r_name AS region,
         CASE WHEN s_acctbal < 0 THEN 'maintenance' ELSE 'active' END AS status
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

E_CUST_CTE = """
ec AS (
  SELECT c_custkey AS entity_id, c_name AS name, n_name AS field, r_name AS region,
         CASE WHEN c_acctbal < 0 THEN 'maintenance' ELSE 'active' END AS status
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""

F_CTE = """
f AS (SELECT user_id AS entity_id, ts AS failure_time FROM events WHERE event_type = 'error' AND value > 100)"""

V_CTE = """
v AS (
  SELECT CAST(l_shipdate AS DATE) AS delivery_date, l_suppkey % 8 AS route, l_suppkey AS driver_id,
         l_returnflag AS category, l_quantity AS volume, l_quantity * 10 AS distance,
         l_extendedprice AS cost, round(l_tax * 100) AS delay,
         l_extendedprice / (l_quantity * 10) AS cost_per_km,
         CASE WHEN round(l_tax * 100) > 2 THEN 1 ELSE 0 END AS is_delayed
  FROM lineitem)"""


def r6(expr: str) -> str:
    """Tie-stable rounding to 6 decimals: snap to integer nanos, then round
    half up to micros. Plain IEEE operations, so both engines agree even when
    their sums differ in the last bit (see ``round6`` in queries.py)."""
    return f"(floor(floor(({expr}) * 1e9 + 0.5) / 1000.0 + 0.5) / 1e6)"


def fence_sql(x: str, q1: str, q3: str, k: float) -> str:
    """W2's test: fences and value compared at 6 decimals."""
    iqr = f"({q3} - {q1})"
    return (f"coalesce({r6(iqr)} = 0 OR ({r6(x)} >= {r6(f'{q1} - {k} * {iqr}')} AND {r6(x)} <= {r6(f'{q3} + {k} * {iqr}')}), false)")


def clean_fact_sql(src: str, out: str) -> str:
    """L1 on view ``src`` as CTE ``out`` (median fill, fences, clip, fallback)."""
    return f"""
{out}_m AS (SELECT entity_id, median(water) AS mw, median(flow) AS mf FROM {src} GROUP BY entity_id),
{out}_w1 AS (
  SELECT s.entity_id, s.day, coalesce(s.flow, m.mf) AS flow, s.oil, coalesce(s.water, m.mw) AS water, s.downtime
  FROM {src} s LEFT JOIN {out}_m m ON s.entity_id = m.entity_id),
{out}_q AS (SELECT entity_id, quantile_cont(flow, 0.25) AS q1, quantile_cont(flow, 0.75) AS q3
            FROM {out}_w1 GROUP BY entity_id),
{out} AS (
  SELECT w.entity_id, w.day, w.flow,
         coalesce(w.oil, w.flow * 0.9) AS oil, w.water,
         CASE WHEN w.downtime < 0 THEN 0.0 WHEN w.downtime > 24 THEN 24.0 ELSE w.downtime END AS downtime
  FROM {out}_w1 w LEFT JOIN {out}_q q ON w.entity_id = q.entity_id
  WHERE w.entity_id IS NOT NULL AND {fence_sql("w.flow", "q.q1", "q.q3", 1.5)})"""


CLEAN_D = "WITH " + D_CTE + "," + clean_fact_sql("d", "cd")
CLEAN_U = "WITH " + U_CTE + "," + clean_fact_sql("u", "cu")

# L2 on r: median fill of value, k, runtime; ranges; clip runtime to [0, 24].
CLEAN_R_CTE = """
rm AS (SELECT entity_id, median(value) AS mv, median(k) AS mk, median(runtime) AS mr FROM r GROUP BY entity_id),
cr AS (
  SELECT event_id, entity_id, ts, event_type, value, k,
         CASE WHEN runtime < 0 THEN 0.0 WHEN runtime > 24 THEN 24.0 ELSE runtime END AS runtime,
         CAST(ts AS DATE) AS day
  FROM (SELECT r.event_id, r.entity_id, r.ts, r.event_type, coalesce(r.value, rm.mv) AS value,
               coalesce(r.k, rm.mk) AS k, coalesce(r.runtime, rm.mr) AS runtime
        FROM r LEFT JOIN rm ON r.entity_id = rm.entity_id)
  WHERE coalesce(value BETWEEN 0.5 AND 1000, false) AND coalesce(k BETWEEN 2 AND 97, false))"""


def _r6(cols: list[str]) -> str:
    return ", ".join(f"{r6(c)} AS {c.split('.')[-1]}" for c in cols)


def xsum(x: str) -> str:
    """A sum of doubles (with compensation, so that row order hardly shows)."""
    return f"fsum({x})"


def xavg(x: str) -> str:
    return f"({xsum(x)} / nullif(count({x}), 0))"


ORACLE: dict[str, str] = {}

ORACLE["clean_daily_fact"] = CLEAN_D + f"""
SELECT entity_id, day, {_r6(['flow', 'oil', 'water', 'downtime'])} FROM cd"""

ORACLE["clean_daily_fact_range"] = ORACLE["clean_daily_fact"]

ORACLE["clean_readings"] = "WITH " + R_CTE + "," + CLEAN_R_CTE + f"""
SELECT event_id, entity_id, ts, event_type, {_r6(['value', 'k', 'runtime'])}, day FROM cr"""

ORACLE["production_daily"] = CLEAN_D + """,
pd AS (
SELECT day, coalesce(""" + xsum("oil") + """, 0) AS total_oil_tons, """ + xavg("flow") + """ AS avg_flow_rate_tpd,
       coalesce(""" + xsum("downtime") + """, 0) AS total_downtime_hours, count(DISTINCT entity_id) AS active_wells
FROM cd GROUP BY day)
SELECT day, """ + _r6(["total_oil_tons", "avg_flow_rate_tpd", "total_downtime_hours"]) + """, active_wells FROM pd"""

KPI_CTE = f""",
kpi AS (
  SELECT k.*, es.name, es.field, es.region, es.status,
         k.downtime_hours / (k.days_count * 24) * 100 AS downtime_pct
  FROM (SELECT entity_id, {xavg('flow')} AS avg_flow_rate_tpd, coalesce({xsum('oil')}, 0) AS total_oil_tons,
               coalesce({xsum('downtime')}, 0) AS downtime_hours, count(DISTINCT day) AS days_count
        FROM cd GROUP BY entity_id) k
  LEFT JOIN es ON k.entity_id = es.entity_id)"""

KPI_BASE = CLEAN_D + "," + E_SUPP_CTE + KPI_CTE

ORACLE["entity_kpi"] = KPI_BASE + f"""
SELECT entity_id, {_r6(['avg_flow_rate_tpd', 'total_oil_tons', 'downtime_hours'])}, days_count,
       name, field, region, status, {r6('downtime_pct')} AS downtime_pct
FROM kpi"""

RD_CTE = f"""
rd AS (SELECT entity_id, day, {xavg('value')} AS avg_value, {xavg('k')} AS avg_k,
              coalesce({xsum('runtime')}, 0.0) AS runtime_hours
       FROM cr WHERE entity_id IS NOT NULL AND day IS NOT NULL GROUP BY entity_id, day)"""

FEAT_BASE = ("WITH " + U_CTE + "," + clean_fact_sql("u", "cu") + "," + CLEAN_R_CTE + "," + RD_CTE + ","
             + E_CUST_CTE + """,
feat AS (
  SELECT cu.entity_id, cu.day, cu.flow, cu.oil, cu.water, cu.downtime,
         rd.avg_value, rd.avg_k, rd.runtime_hours, cu.downtime / 24.0 AS downtime_ratio, ec.field, ec.region
  FROM cu LEFT JOIN rd ON cu.entity_id = rd.entity_id AND cu.day = rd.day
  LEFT JOIN ec ON cu.entity_id = ec.entity_id)""")

Z_CTE = """
st AS (SELECT entity_id, avg(value) AS mv, stddev_samp(value) AS sv, avg(k) AS mk, stddev_samp(k) AS sk
       FROM r WHERE entity_id IS NOT NULL GROUP BY entity_id),
z AS (
  SELECT r.event_id, r.entity_id, r.ts, r.value, r.k,
         coalesce((r.value - st.mv) / nullif(st.sv, 0), 0.0) AS z_value,
         coalesce((r.k - st.mk) / nullif(st.sk, 0), 0.0) AS z_k
  FROM r LEFT JOIN st ON r.entity_id = st.entity_id),
zl AS (
  SELECT z.*, CASE WHEN abs(z_value) > 3 OR abs(z_k) > 3 THEN 1 ELSE 0 END AS is_anomaly,
         greatest(abs(z_value), abs(z_k)) AS risk_score,
         CASE WHEN EXISTS (SELECT 1 FROM f WHERE f.entity_id = z.entity_id AND z.ts <= f.failure_time
                           AND z.ts >= f.failure_time - INTERVAL 7 DAY) THEN 1 ELSE 0 END AS failure_within_7d
  FROM z)"""

ORACLE["entity_ranking"] = KPI_BASE + f""",
rk AS (SELECT entity_id, avg_flow_rate_tpd,
              CAST(dense_rank() OVER (ORDER BY avg_flow_rate_tpd DESC) AS BIGINT) AS rank_by_flow FROM kpi)
SELECT entity_id, {r6('avg_flow_rate_tpd')} AS avg_flow_rate_tpd, rank_by_flow,
       CASE WHEN rank_by_flow <= 3 THEN 'best'
            WHEN rank_by_flow > (SELECT count(*) FROM kpi) - 3 THEN 'worst' ELSE 'middle' END AS well_group
FROM rk"""

ORACLE["entity_ranking_range"] = ORACLE["entity_ranking"]

ORACLE["readings_daily"] = "WITH " + R_CTE + "," + CLEAN_R_CTE + "," + RD_CTE + f"""
SELECT entity_id, day, {_r6(['avg_value', 'avg_k', 'runtime_hours'])} FROM rd"""

ORACLE["readings_daily_raw"] = "WITH " + R_CTE + f""",
a4 AS (SELECT entity_id, CAST(ts AS DATE) AS day, {xavg('value')} AS avg_value, {xavg('k')} AS avg_k,
              coalesce({xsum('runtime')}, 0.0) AS runtime_hours
       FROM r WHERE entity_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2)
SELECT entity_id, day, {_r6(['avg_value', 'avg_k', 'runtime_hours'])} FROM a4"""

ORACLE["features_daily"] = FEAT_BASE + f"""
SELECT entity_id, day, {_r6(['flow', 'oil', 'water', 'downtime', 'avg_value', 'avg_k', 'runtime_hours',
                              'downtime_ratio'])}, field, region FROM feat"""


def bin_ctes(name: str, x: str, src: str, bins: int = 6) -> str:
    """pd.cut's rule as an edge table {name}_e (j, lo, hi), j from 1: a value lies in
    the bin whose edges enclose it, lowest edge lowered by 0.1 % of the range."""
    return f"""
{name}_s AS (SELECT CAST(min({x}) AS DOUBLE) AS mn, CAST(max({x}) AS DOUBLE) AS mx FROM {src}),
{name}_r AS (SELECT mn, mx, CASE WHEN mn = mx THEN mn - (CASE WHEN mn = 0 THEN 0.001::DOUBLE ELSE abs(mn) * 0.001::DOUBLE END) ELSE mn END AS lo,
                    CASE WHEN mn = mx THEN mx + (CASE WHEN mn = 0 THEN 0.001::DOUBLE ELSE abs(mn) * 0.001::DOUBLE END) ELSE mx END AS hi FROM {name}_s),
{name}_j AS (SELECT CAST(unnest(range(0, {bins + 1})) AS INTEGER) AS j),
{name}_p AS (SELECT j, CASE WHEN j = {bins} THEN hi WHEN j = 0 AND mn <> mx THEN lo - (hi - lo) * 0.001::DOUBLE
                            ELSE lo + j::DOUBLE * ((hi - lo) / {bins}::DOUBLE) END AS edge FROM {name}_j, {name}_r),
{name}_e AS (SELECT a.j + 1 AS idx, a.edge AS lo, b.edge AS hi,
                    '(' || CAST(round(a.edge, 3) AS VARCHAR) || ', ' || CAST(round(b.edge, 3) AS VARCHAR) || ']' AS label
             FROM {name}_p a JOIN {name}_p b ON b.j = a.j + 1)"""


ORACLE["bin_heatmap"] = FEAT_BASE + "," + bin_ctes("pb", "avg_value", "feat") + "," + bin_ctes("tb", "avg_k", "feat") + f""",
b AS (SELECT flow, entity_id, pb_e.idx AS pressure_bin_idx, coalesce(pb_e.label, 'nan') AS pressure_bin,
             tb_e.idx AS temperature_bin_idx, coalesce(tb_e.label, 'nan') AS temperature_bin
      FROM feat LEFT JOIN pb_e ON avg_value > pb_e.lo AND avg_value <= pb_e.hi
                LEFT JOIN tb_e ON avg_k > tb_e.lo AND avg_k <= tb_e.hi),
h AS (SELECT pressure_bin_idx, pressure_bin, temperature_bin_idx, temperature_bin,
             {xavg('flow')} AS avg_flow_rate_tpd, count(entity_id) AS observations
      FROM b GROUP BY ALL)
SELECT pressure_bin_idx, pressure_bin, temperature_bin_idx, temperature_bin,
       {r6('avg_flow_rate_tpd')} AS avg_flow_rate_tpd, observations FROM h"""

ORACLE["bin_edges"] = "WITH li AS (SELECT l_linenumber, 1.0::DOUBLE AS one FROM lineitem)," + bin_ctes("lb", "l_linenumber", "li") + "," + bin_ctes("ob", "one", "li") + """
SELECT l_linenumber, lb_e.idx AS line_bin_idx, lb_e.label AS line_bin, ob_e.idx AS one_bin_idx, ob_e.label AS one_bin, count(*) AS rows_count
FROM li LEFT JOIN lb_e ON l_linenumber > lb_e.lo AND l_linenumber <= lb_e.hi LEFT JOIN ob_e ON one > ob_e.lo AND one <= ob_e.hi
GROUP BY ALL"""

ORACLE["group_zscore_flags"] = "WITH " + R_CTE + "," + F_CTE + "," + Z_CTE + f"""
SELECT event_id, entity_id, ts, {_r6(['value', 'k', 'z_value', 'z_k'])}, is_anomaly FROM zl"""

ORACLE["failure_within_horizon"] = "WITH " + R_CTE + "," + F_CTE + """
SELECT event_id, entity_id, ts,
       CASE WHEN EXISTS (SELECT 1 FROM f WHERE f.entity_id = r.entity_id AND r.ts <= f.failure_time
                         AND r.ts >= f.failure_time - INTERVAL 7 DAY) THEN 1 ELSE 0 END AS failure_within_7d
FROM r"""

ORACLE["delay_by_category"] = "WITH " + V_CTE + f"""
SELECT category, {r6(xavg('delay'))} AS avg_delay_hours, {r6(xavg('is_delayed'))} AS delayed_share,
       count(*) AS deliveries_count
FROM v WHERE category IS NOT NULL GROUP BY category"""

COST_CTE = f""",
cr_ AS (SELECT route, {xavg('distance')} AS avg_distance_km, {xavg('cost')} AS avg_cost_rub,
               {xavg('cost_per_km')} AS avg_cost_per_km, count(*) AS deliveries_count
        FROM v WHERE route IS NOT NULL GROUP BY route)"""

ORACLE["cost_by_route"] = "WITH " + V_CTE + COST_CTE + f"""
SELECT route, {_r6(['avg_distance_km', 'avg_cost_rub', 'avg_cost_per_km'])}, deliveries_count FROM cr_"""

ORACLE["route_recommendation"] = "WITH " + V_CTE + COST_CTE + f"""
SELECT route, {_r6(['avg_distance_km', 'avg_cost_rub', 'avg_cost_per_km'])}, deliveries_count,
       CAST(dense_rank() OVER (ORDER BY avg_cost_per_km) AS BIGINT) AS recommendation
FROM cr_"""

ORACLE["driver_kpi"] = "WITH " + V_CTE + f""",
dk AS (SELECT driver_id, {xavg('delay')} AS avg_delay_hours, {xavg('is_delayed')} AS delayed_share,
              {xavg('cost_per_km')} AS avg_cost_per_km, coalesce({xsum('volume')}, 0) AS total_volume_tons,
              count(*) AS deliveries_count
       FROM v WHERE driver_id IS NOT NULL GROUP BY driver_id)
SELECT driver_id, {_r6(['avg_delay_hours', 'delayed_share', 'avg_cost_per_km', 'total_volume_tons'])},
       deliveries_count FROM dk"""

ORACLE["top_entities"] = KPI_BASE + f"""
SELECT entity_id, name, {_r6(['avg_flow_rate_tpd', 'downtime_pct', 'total_oil_tons'])}
FROM kpi ORDER BY avg_flow_rate_tpd DESC, entity_id LIMIT 10"""

_KPI_CARDS = f"""
SELECT {r6(f"coalesce({xsum('oil')}, 0)")} AS total_oil_tons, {r6(xavg('flow'))} AS avg_flow_rate_tpd,
       {r6(xavg('avg_value'))} AS avg_pressure_atm,
       {r6(f"coalesce({xsum('downtime')}, 0) / (count(*) * 24.0) * 100")} AS downtime_pct,
       count(*) AS rows_count
FROM feat"""

ORACLE["kpi_cards"] = FEAT_BASE + _KPI_CARDS
ORACLE["kpi_cards_filtered"] = FEAT_BASE + _KPI_CARDS + """
WHERE day >= DATE '2024-01-05' AND day <= DATE '2024-01-25' AND region IN ('ASIA', 'EUROPE', 'AMERICA')"""

ORACLE["downtime_summary"] = KPI_BASE + f""",
ds AS (SELECT region, coalesce({xsum('downtime_hours')}, 0) AS downtime_hours,
              CAST(sum(days_count) AS BIGINT) AS days_count, count(*) AS wells
       FROM kpi WHERE region IS NOT NULL GROUP BY region)
SELECT region, {r6('downtime_hours')} AS downtime_hours, days_count, wells,
       {r6('downtime_hours / (days_count * 24.0) * 100')} AS downtime_pct
FROM ds"""

ORACLE["max_risk_by_entity"] = "WITH " + R_CTE + "," + F_CTE + "," + Z_CTE + f"""
SELECT entity_id, {r6('max(risk_score)')} AS max_risk FROM zl WHERE entity_id IS NOT NULL GROUP BY entity_id"""

ORACLE["pre_failure_curve"] = "WITH " + R_CTE + "," + F_CTE + "," + Z_CTE + f"""
SELECT entity_id, ts, {r6('risk_score')} AS risk_score, is_anomaly, failure_within_7d
FROM zl WHERE failure_within_7d = 1 ORDER BY ts, entity_id"""

ORACLE["null_counts"] = "WITH " + R_CTE + """
SELECT count(*) FILTER (WHERE event_id IS NULL) AS nulls_event_id,
       count(*) FILTER (WHERE entity_id IS NULL) AS nulls_entity_id,
       count(*) FILTER (WHERE ts IS NULL) AS nulls_ts,
       count(*) FILTER (WHERE event_type IS NULL) AS nulls_event_type,
       count(*) FILTER (WHERE value IS NULL) AS nulls_value,
       count(*) FILTER (WHERE k IS NULL) AS nulls_k,
       count(*) FILTER (WHERE runtime IS NULL) AS nulls_runtime
FROM r"""

ORACLE["duplicate_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS rows_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""

ORACLE["orphan_keys"] = """
SELECT 'lineitem.l_orderkey' AS check_name, count(*) AS violations FROM lineitem
 WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
UNION ALL
SELECT 'lineitem.l_partkey', count(*) FROM lineitem
 WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)
UNION ALL
SELECT 'lineitem.l_suppkey', count(*) FROM lineitem
 WHERE l_suppkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey)
UNION ALL
SELECT 'orders.o_custkey', count(*) FROM orders
 WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
UNION ALL
SELECT 'events.user_id', count(*) FROM events
 WHERE user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id)"""

ORACLE["missing_days"] = "WITH " + D_CTE + """,
span AS (SELECT entity_id, min(day) AS lo, max(day) AS hi FROM d WHERE entity_id IS NOT NULL GROUP BY entity_id),
grid AS (SELECT entity_id, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM span)
SELECT entity_id, day FROM grid
WHERE NOT EXISTS (SELECT 1 FROM d WHERE d.entity_id = grid.entity_id AND d.day = grid.day)"""

ORACLE["insert_ignore"] = f"""
WITH fa AS (SELECT l_suppkey AS entity_id, CAST(l_shipdate AS DATE) AS day, l_returnflag AS flag,
                   sum(l_quantity) AS qty, count(*) AS lines
            FROM lineitem GROUP BY 1, 2, 3),
old AS (SELECT * FROM fa WHERE flag = 'N'),
pick AS (SELECT * FROM fa WHERE flag IN ('A', 'R')
         QUALIFY row_number() OVER (PARTITION BY entity_id, day ORDER BY flag) = 1),
res AS (SELECT * FROM old
        UNION ALL
        SELECT * FROM pick WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.entity_id = pick.entity_id
                                                                 AND old.day = pick.day))
SELECT entity_id, day, flag, {r6('qty')} AS qty, lines FROM res"""

ORACLE["conditional_update"] = f"""
SELECT event_id, event_type,
       {r6('CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 173 = 0 THEN value * 4 ELSE value END')} AS value
FROM events"""

ORACLE["derive_targets"] = "WITH " + D_CTE + f"""
SELECT entity_id, day, {r6('coalesce(flow, oil)')} AS actual_flow_rate_tpd FROM d"""

ORACLE["union_all"] = """
SELECT user_id AS entity_id, ts AS failure_time, 'error_spike' AS failure_type FROM events
 WHERE event_type = 'error' AND value > 100
UNION ALL
SELECT user_id, ts, 'purchase_spike' FROM events WHERE event_type = 'purchase' AND value > 300
UNION ALL
SELECT user_id, ts, 'click_spike' FROM events WHERE event_type = 'click' AND value > 400"""

ID_HASH = "('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8))::BIGINT"

ORACLE["hash_split"] = f"""
SELECT event_id, CASE WHEN {ID_HASH} % 100 < 25 THEN 1 ELSE 0 END AS is_test FROM events"""

LAB_CTE = R_CTE + "," + F_CTE + """,
lab AS (
  SELECT r.*, CASE WHEN EXISTS (SELECT 1 FROM f WHERE f.entity_id = r.entity_id AND r.ts <= f.failure_time
                                AND r.ts >= f.failure_time - INTERVAL 7 DAY) THEN 1 ELSE 0 END AS failure_within_7d
  FROM r)"""

ORACLE["stratified_hash_split"] = "WITH " + LAB_CTE + f""",
hh AS (SELECT event_id, failure_within_7d, {ID_HASH} AS h FROM lab)
SELECT event_id, failure_within_7d,
       CASE WHEN row_number() OVER (PARTITION BY failure_within_7d ORDER BY h, event_id) - 1
                 < ceil(0.25 * count(*) OVER (PARTITION BY failure_within_7d)) THEN 1 ELSE 0 END AS is_test
FROM hh"""

ORACLE["class_weights"] = "WITH " + LAB_CTE + f""",
cw AS (SELECT failure_within_7d, count(*) AS n_c,
              (SELECT count(*) FROM lab) / ((SELECT count(DISTINCT failure_within_7d) FROM lab) * count(*)) AS w
       FROM lab GROUP BY failure_within_7d)
SELECT failure_within_7d, n_c, {r6('w')} AS w FROM cw"""

ORACLE["regression_metrics"] = f"""
WITH m AS (
  SELECT 'rate_1000' AS model_name, 0 AS model_order, avg(abs(l_extendedprice - l_quantity * 1000.0)) AS mae,
         sqrt(avg(pow(l_extendedprice - l_quantity * 1000.0, 2))) AS rmse, count(*) AS rows_count FROM lineitem
  UNION ALL
  SELECT 'rate_1500', 1, avg(abs(l_extendedprice - l_quantity * 1500.0)),
         sqrt(avg(pow(l_extendedprice - l_quantity * 1500.0, 2))), count(*) FROM lineitem)
SELECT model_name, model_order, {_r6(['mae', 'rmse'])}, rows_count,
       CASE WHEN model_order = (SELECT model_order FROM m ORDER BY rmse, model_order LIMIT 1) THEN 1 ELSE 0 END AS is_best
FROM m"""

ORACLE["classification_metrics"] = "WITH " + R_CTE + "," + F_CTE + "," + Z_CTE + f""",
rk AS (SELECT failure_within_7d AS y, risk_score AS s,
              rank() OVER (ORDER BY risk_score) + (count(*) OVER (PARTITION BY risk_score) - 1) / 2.0 AS mid
       FROM zl WHERE risk_score IS NOT NULL),
auc AS (SELECT (sum(CASE WHEN y = 1 THEN mid ELSE 0 END) - sum(y) * (sum(y) + 1) / 2.0)
               / (sum(y) * (count(*) - sum(y))) AS roc_auc FROM rk)
SELECT {r6('avg(CASE WHEN failure_within_7d = CASE WHEN risk_score > 1.0 THEN 1 ELSE 0 END THEN 1.0 ELSE 0.0 END)')} AS accuracy,
       (SELECT {r6('roc_auc')} FROM auc) AS roc_auc, count(*) AS rows_count
FROM zl"""

ORACLE["linear_fit_one_feature"] = f"""
SELECT {r6('regr_slope(l_extendedprice, l_quantity)')} AS slope,
       {r6('regr_intercept(l_extendedprice, l_quantity)')} AS intercept, count(*) AS rows_count
FROM lineitem"""

ORACLE["flow_dataset"] = "WITH " + U_CTE + f""",
t AS (SELECT entity_id, day, coalesce(flow, oil) AS actual_flow_rate_tpd FROM u),
a4 AS (SELECT entity_id, CAST(ts AS DATE) AS day, {xavg('value')} AS avg_value, {xavg('k')} AS avg_k,
              coalesce({xsum('runtime')}, 0.0) AS runtime_hours
       FROM r WHERE entity_id IS NOT NULL AND ts IS NOT NULL GROUP BY 1, 2),
ds AS (SELECT t.entity_id, t.day, t.actual_flow_rate_tpd, a4.avg_value, a4.avg_k, a4.runtime_hours
       FROM t JOIN a4 ON t.entity_id = a4.entity_id AND t.day = a4.day
       WHERE a4.avg_value IS NOT NULL AND a4.avg_k IS NOT NULL AND a4.runtime_hours IS NOT NULL
         AND t.actual_flow_rate_tpd IS NOT NULL)
SELECT entity_id, day, {_r6(['actual_flow_rate_tpd', 'avg_value', 'avg_k', 'runtime_hours'])} FROM ds"""

ORACLE["export_round_trip"] = f"""
SELECT CAST(o_orderdate AS DATE) AS o_orderdate, count(*) AS rows_count, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE), 2) AS total_price
FROM orders GROUP BY 1"""

# Kept from run to run: the one-go results.
for _merged in ("clean_daily_fact", "clean_readings", "production_daily", "entity_kpi", "readings_daily"):
    ORACLE[f"{_merged}_merged"] = ORACLE[_merged]
ORACLE["distinct_merged"] = """
SELECT l_suppkey AS entity_id, count(DISTINCT CAST(l_shipdate AS DATE)) AS days_count FROM lineitem GROUP BY 1"""

# S11 twins: the marts' SQL, then the dashboard SELECT itself.
ORACLE["sql_q1_daily_oil"] = CLEAN_D + f""",
pd AS (SELECT day, coalesce({xsum('oil')}, 0) AS total_oil_tons, {xavg('flow')} AS avg_flow_rate_tpd FROM cd GROUP BY day)
SELECT day AS production_date, {_r6(['total_oil_tons', 'avg_flow_rate_tpd'])} FROM pd"""
ORACLE["sql_q2_well_kpi"] = KPI_BASE + f"""
SELECT name AS well_name, {_r6(['avg_flow_rate_tpd', 'downtime_pct', 'total_oil_tons'])} FROM kpi"""
ORACLE["sql_q3_heatmap"] = ORACLE["bin_heatmap"].replace(
    "SELECT pressure_bin_idx, pressure_bin, temperature_bin_idx, temperature_bin,\n       ",
    "SELECT pressure_bin, temperature_bin, ")
ORACLE["sql_q5_anomalies"] = "WITH " + R_CTE + "," + F_CTE + "," + Z_CTE + f"""
SELECT ts AS event_time, entity_id AS pump_id, {r6('value')} AS vibration_mm_s, {r6('k')} AS temperature_c,
       {r6('z_value')} AS current_a, {r6('z_k')} AS rpm, {r6('risk_score')} AS risk_score
FROM zl WHERE is_anomaly = 1"""
ORACLE["sql_q6_delay_weather"] = ORACLE["delay_by_category"].replace("SELECT category,", "SELECT category AS weather,")
ORACLE["sql_q7_driver_kpi"] = "WITH " + V_CTE + f""",
dk AS (SELECT driver_id, {xavg('is_delayed')} AS delayed_share, {xavg('cost_per_km')} AS avg_cost_per_km,
              coalesce({xsum('volume')}, 0) AS total_volume_tons, count(*) AS deliveries_count
       FROM v WHERE driver_id IS NOT NULL GROUP BY driver_id)
SELECT driver_id, {_r6(['delayed_share', 'avg_cost_per_km', 'total_volume_tons'])}, deliveries_count FROM dk"""
ORACLE["sql_q10_cost_distance"] = "WITH " + V_CTE + COST_CTE + f"""
SELECT route, {_r6(['avg_distance_km', 'avg_cost_rub'])} FROM cr_"""

ORACLE["fence_ties"] = f"""
WITH li AS (SELECT l_suppkey AS entity_id, l_orderkey, l_linenumber, l_tax * 100 AS pct FROM lineitem),
q AS (SELECT entity_id, quantile_cont(pct, 0.25) AS q1, quantile_cont(pct, 0.75) AS q3 FROM li GROUP BY entity_id)
SELECT li.entity_id, l_orderkey, l_linenumber, {r6('pct')} AS pct FROM li JOIN q ON li.entity_id = q.entity_id
WHERE {fence_sql('pct', 'q1', 'q3', 0.5)}"""

ORACLE["bad_distance"] = "WITH " + V_CTE + """
SELECT route, count(*) FILTER (WHERE distance IS NULL OR distance = 0) AS bad_distance, count(*) AS deliveries_count
FROM v WHERE route IS NOT NULL GROUP BY route"""

ORACLE["pre_failure_vibration"] = "WITH " + R_CTE + "," + F_CTE + "," + Z_CTE + f"""
SELECT entity_id, ts, {r6('value')} AS vibration, {r6('risk_score')} AS risk_score FROM zl WHERE failure_within_7d = 1"""

ORACLE["insert_targets"] = "WITH " + D_CTE + f""",
old AS (SELECT l_suppkey AS entity_id, CAST(l_shipdate AS DATE) AS day, {xavg('l_extendedprice')} AS actual_flow_rate_tpd
        FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2),
res AS (SELECT * FROM old UNION ALL
        SELECT entity_id, day, coalesce(flow, oil) FROM d
        WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.entity_id = d.entity_id AND old.day = d.day))
SELECT entity_id, day, {r6('actual_flow_rate_tpd')} AS actual_flow_rate_tpd FROM res"""

ORACLE["append_rows"] = f"""
SELECT user_id, event_type, {r6('value')} AS value FROM events
UNION ALL SELECT user_id, event_type, {r6('value')} FROM events WHERE event_type = 'error'"""

# O1-O3: every row's place in the query's own order.
PLACES = {
    "sql_q1_daily_oil": "production_date",
    "sql_q2_well_kpi": "avg_flow_rate_tpd DESC NULLS LAST, well_name",
    "sql_q5_anomalies": "event_time, pump_id, vibration_mm_s, temperature_c",
    "sql_q6_delay_weather": "avg_delay_hours DESC NULLS LAST, weather",
    "sql_q7_driver_kpi": "delayed_share, avg_cost_per_km, driver_id",
    "sql_q10_cost_distance": "route",
    "pre_failure_curve": "ts, entity_id, risk_score",
    "pre_failure_vibration": "entity_id, ts, vibration, risk_score",
}
for _name, _order in PLACES.items():
    ORACLE[_name] = f"SELECT *, row_number() OVER (ORDER BY {_order}) AS place FROM ({ORACLE[_name]}) q"

# Models: what SQL can state. The linear fit by its normal equations, solved by
# elimination on centred sums.
DS_CTES = ORACLE["flow_dataset"].split("SELECT entity_id, day, (floor")[0].rstrip()

ORACLE["linear_fit_residuals"] = DS_CTES + """,
m AS (SELECT avg(actual_flow_rate_tpd) AS my, avg(avg_value) AS m1, avg(avg_k) AS m2, avg(runtime_hours) AS m3 FROM ds),
c AS (SELECT ds.entity_id, ds.day, actual_flow_rate_tpd - my AS y, avg_value - m1 AS a, avg_k - m2 AS b, runtime_hours - m3 AS g FROM ds, m),
n AS (SELECT sum(a*a) AS aa, sum(a*b) AS ab, sum(a*g) AS ag, sum(b*b) AS bb, sum(b*g) AS bg, sum(g*g) AS gg,
             sum(a*y) AS ay, sum(b*y) AS byy, sum(g*y) AS gy FROM c),
e1 AS (SELECT aa, ab, ag, ay, bb - ab*ab/aa AS b2, bg - ab*ag/aa AS bg2, gg - ag*ag/aa AS g2, byy - ab*ay/aa AS by2, gy - ag*ay/aa AS gy2 FROM n),
e2 AS (SELECT *, (gy2 - bg2*by2/b2) / (g2 - bg2*bg2/b2) AS wg FROM e1),
e3 AS (SELECT *, (by2 - bg2*wg) / b2 AS wb FROM e2),
w AS (SELECT (ay - ab*wb - ag*wg) / aa AS wa, wb, wg FROM e3)
SELECT entity_id, day, """ + r6("(y - wa*a - wb*b - wg*g) / 100") + """ * 100 AS residual FROM c, w"""

IS_TEST = f"(CASE WHEN {HASH} % 100 < 25 THEN 1 ELSE 0 END)"
ORACLE["flow_predictions"] = DS_CTES + f"""
SELECT entity_id, day, {r6('actual_flow_rate_tpd')} AS actual_flow_rate_tpd, {IS_TEST} AS is_test, 1 AS error_ok, 1 AS model_ok FROM ds"""
LINEAR_CTES = DS_CTES + f""",
dt AS (SELECT *, {IS_TEST} AS is_test FROM ds),
m AS (SELECT avg(actual_flow_rate_tpd) AS my, avg(avg_value) AS m1, avg(avg_k) AS m2, avg(runtime_hours) AS m3 FROM dt WHERE is_test = 0),
c AS (SELECT dt.*, actual_flow_rate_tpd - my AS y, avg_value - m1 AS a, avg_k - m2 AS b, runtime_hours - m3 AS g FROM dt, m),
n AS (SELECT sum(a*a) AS aa, sum(a*b) AS ab, sum(a*g) AS ag, sum(b*b) AS bb, sum(b*g) AS bg, sum(g*g) AS gg,
             sum(a*y) AS ay, sum(b*y) AS byy, sum(g*y) AS gy FROM c WHERE is_test = 0),
e1 AS (SELECT aa, ab, ag, ay, bb - ab*ab/aa AS b2, bg - ab*ag/aa AS bg2, gg - ag*ag/aa AS g2, byy - ab*ay/aa AS by2, gy - ag*ay/aa AS gy2 FROM n),
e2 AS (SELECT *, (gy2 - bg2*by2/b2) / (g2 - bg2*bg2/b2) AS wg FROM e1),
e3 AS (SELECT *, (by2 - bg2*wg) / b2 AS wb FROM e2),
w AS (SELECT (ay - ab*wb - ag*wg) / aa AS wa, wb, wg FROM e3),
lin AS (SELECT c.*, my + wa*a + wb*b + wg*g AS p FROM c, w, m)"""
ORACLE["sql_q4_predictions"] = LINEAR_CTES + f"""
SELECT day AS target_date, entity_id AS well_id, {r6('actual_flow_rate_tpd')} AS actual_flow_rate_tpd, {r6('p / 100')} * 100 AS predicted_flow_rate_tpd,
       {r6('abs(actual_flow_rate_tpd - p) / 100')} * 100 AS absolute_error, row_number() OVER (ORDER BY day, entity_id) AS place FROM lin"""
ORACLE["model_metrics"] = LINEAR_CTES + f""",
n2 AS (SELECT count(*) FILTER (WHERE is_test = 0) AS rows_train, count(*) FILTER (WHERE is_test = 1) AS rows_test,
              avg(abs(actual_flow_rate_tpd - p)) FILTER (WHERE is_test = 1) AS e1,
              sqrt(avg(pow(actual_flow_rate_tpd - p, 2)) FILTER (WHERE is_test = 1)) AS e2 FROM lin)
SELECT 'linear_regression' AS model_name, {r6('e1 / 100')} * 100 AS mae, {r6('e2 / 100')} * 100 AS rmse, rows_train, rows_test, 1 AS errors_ok, 1 AS best_ok FROM n2
UNION ALL SELECT 'random_forest', NULL, NULL, rows_train, rows_test, 1, 1 FROM n2"""
ORACLE["sql_q8_model_metrics"] = ORACLE["model_metrics"]
ORACLE["tree_leaf_means"] = DS_CTES + "\nSELECT entity_id, day, 0.0::DOUBLE AS from_leaf_mean, 3 AS leaf_rows FROM ds"
ORACLE["tree_leaf_shares"] = "WITH " + R_CTE + "\nSELECT event_id, 0.0::DOUBLE AS from_leaf_share, 3 AS leaf_rows FROM r"

RISK_CTES = "WITH " + R_CTE + "," + F_CTE + "," + Z_CTE + """,
risk AS (SELECT *, CAST(ts AS DATE) AS event_date FROM zl WHERE value IS NOT NULL AND k IS NOT NULL)"""
ORACLE["failure_risk"] = RISK_CTES + """
SELECT entity_id, ts, failure_within_7d, is_anomaly, event_date, 1 AS risk_ok FROM risk"""
ORACLE["pump_anomalies"] = RISK_CTES + f"""
SELECT entity_id, ts, {_r6(['value', 'k'])}, is_anomaly, failure_within_7d, event_date, 1 AS risk_ok FROM risk WHERE is_anomaly = 1"""
ORACLE["sql_q8_failure_metrics"] = RISK_CTES + """,
t AS (SELECT failure_within_7d, CAST(ceil(0.25 * count(*)) AS BIGINT) AS test, count(*) AS n FROM risk GROUP BY 1)
SELECT 'random_forest_classifier' AS model_name, CAST(sum(n - test) AS BIGINT) AS rows_train, CAST(sum(test) AS BIGINT) AS rows_test,
       1 AS accuracy_ok, 1 AS auc_ok FROM t"""

ORACLE["sink_table_formats"] = f"""
SELECT o_orderstatus, count(*) AS rows_count, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE), 2) AS total_price, format
FROM orders, (SELECT unnest(['parquet', 'csv']) AS format) f GROUP BY o_orderstatus, format"""
ORACLE["sink_unpartitioned"] = """
SELECT 'raw/orders' || i AS dataset, CAST(NULL AS VARCHAR) AS partition_value, (SELECT count(*) FROM orders) AS rows_count
FROM (SELECT unnest([0, 1]) AS i) t"""
ORACLE["sink_empty"] = "SELECT count(*) AS rows_kept, 0 AS objects_listed FROM orders"
ORACLE["sink_raw_snapshots"] = "WITH " + R_CTE + "," + D_CTE + """
SELECT 'raw/telemetry' AS dataset, CAST(CAST(ts AS DATE) AS VARCHAR) AS partition_value, count(*) AS rows_count FROM r GROUP BY 2
UNION ALL SELECT 'raw/production', CAST(day AS VARCHAR), count(*) FROM d GROUP BY 2
UNION ALL SELECT 'raw/region', NULL, count(*) FROM region"""
ORACLE["sink_manifest"] = "SELECT CAST(o_orderdate AS DATE) AS o_orderdate, count(*) AS rows_count FROM orders GROUP BY 1"
ORACLE["sink_report"] = f"""
WITH m AS ({ORACLE["regression_metrics"]})
SELECT model_name, mae, rmse, rows_count FROM m"""
ORACLE["sink_statements"] = """
SELECT o_orderpriority, count(*) AS rows_count FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'O' GROUP BY 1"""

ORACLE["production_marts"] = CLEAN_D + "," + R_CTE + "," + CLEAN_R_CTE + "," + RD_CTE + """,
feat AS (SELECT cd.*, rd.avg_value, rd.avg_k FROM cd LEFT JOIN rd ON cd.entity_id = rd.entity_id AND cd.day = rd.day),
""" + bin_ctes("pb", "avg_value", "feat") + "," + bin_ctes("tb", "avg_k", "feat") + """,
b AS (SELECT DISTINCT pb_e.idx AS i, tb_e.idx AS j FROM feat LEFT JOIN pb_e ON avg_value > pb_e.lo AND avg_value <= pb_e.hi
                LEFT JOIN tb_e ON avg_k > tb_e.lo AND avg_k <= tb_e.hi),
n AS (SELECT (SELECT count(*) FROM cd) AS facts, (SELECT count(*) FROM cr) AS readings, (SELECT count(DISTINCT day) FROM cd) AS days,
             (SELECT count(DISTINCT entity_id) FROM cd) AS wells, (SELECT count(*) FROM b) AS cells)
SELECT unnest(['clean_production', 'clean_telemetry', 'mart_production_daily', 'mart_well_kpi', 'mart_well_ranking', 'features_well_daily',
               'mart_pressure_flow_heatmap']) AS mart, unnest([facts, readings, days, wells, wells, facts, cells]) AS rows_count, 1 AS schema_ok FROM n"""
