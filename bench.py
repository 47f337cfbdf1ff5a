"""Time the headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR.

Prints one JSON line: {"metric", "value" (sum of query seconds), "unit",
"queries": {name: sec}, "sf", ...}. Every query first runs once on sf0.001
(generated code is cached by plan shape, so the timed run measures steady
state rather than first compilation), then is timed on the bench scale. Each timed
run executes the whole plan into Spark's ``noop`` sink (every row computed,
nothing shipped to Python), and includes the plan building and any size
checks or materialized intermediates the query makes.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fieldmart.plans.queries import QUERIES  # noqa: E402
from fieldmart.session import get_session, release_materialized  # noqa: E402

HEADLINE = [
    "clean_daily_fact", "clean_daily_fact_range", "clean_readings", "production_daily", "entity_kpi", "entity_ranking",
    "readings_daily", "features_daily", "bin_heatmap", "group_zscore_flags", "failure_within_horizon",
    "delay_by_category", "cost_by_route", "route_recommendation", "driver_kpi", "top_entities",
    "kpi_cards", "downtime_summary", "max_risk_by_entity", "missing_days", "duplicate_keys",
    "insert_ignore", "stratified_hash_split", "classification_metrics", "flow_dataset", "regression_metrics",
    "linear_fit_residuals", "fence_ties",
]
#: Runs of each query; no further round begins once the bench has taken so long.
RUNS, ENOUGH_S = 3, 150


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app_name="fieldmart-bench")
    warm_dir = re.sub(r"sf[0-9.]+$", "sf0.001", sf_dir.rstrip("/"))
    if os.path.isdir(warm_dir):
        for n in names:
            QUERIES[n](spark, warm_dir).write.format("noop").mode("overwrite").save()
    seen: dict[str, list[float]] = {n: [] for n in names}
    began, runs = time.perf_counter(), 0
    while runs < RUNS and (not runs or time.perf_counter() - began < ENOUGH_S):
        runs += 1
        for n in names:
            t = time.perf_counter()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seen[n].append(time.perf_counter() - t)
        release_materialized(spark)
    times = {n: round(median(v), 3) for n, v in seen.items()}
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf.group(1)) if sf else None,
        "cpus": cpus, "spark": spark.version, "runs": runs, "slowest_run": {n: round(max(v), 3) for n, v in seen.items()},
    }))
    release_materialized(spark)
    spark.stop()


if __name__ == "__main__":
    main()
