"""Benchmark: run the headline queries on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS] and print one JSON line with per-query wall seconds:
``value`` / ``queries`` are the cold runs, ``value_warm`` / ``queries_warm`` a
second pass (set BENCH_WARM=0 to skip it)."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfscope.plans.catalog import run_query  # noqa: E402
from shelfscope.session import get_spark  # noqa: E402
from shelfscope.sources.retail import prepare_fact  # noqa: E402

HEADLINE = [
    "kpi_summary", "monthly_pnl", "margin_trend", "revenue_trend", "store_revenue_dist",
    "customer_spend_dist", "product_margin_dist", "discount_margin_pearson", "spend_revenue_spearman",
    "store_cluster_profile", "tier_revenue", "rfm_segments", "rfm_summary", "anova_oneway",
    "freq_decline_welch", "mann_whitney_u", "ab_welch", "churn_by_tier", "category_performance",
    "dq_checks", "profile_table", "customer_features", "store_features", "product_features",
    "category_elasticity", "whatif_batch", "rice_rank",
]
# model training, run once: the source's published figure is about 5 min for its four model families
TRAINING = ["churn_model_eval", "store_models", "mmm_fit", "product_elasticity"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="bench-")  # one machine: its folder is the shared one
    spark = get_spark("bench", cpus=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, checkpoint_dir=shared)
    from shelfscope.plans.registry import REGISTRY
    names = [q for q in HEADLINE if q in REGISTRY]
    spark.range(1000).selectExpr("sum(id)").collect()  # warm-up (JVM)
    times, warm, training = {}, {}, {}
    t0 = time.perf_counter()
    fact = prepare_fact(spark, sf_dir, f"{shared}/fact", int(cpus) if cpus.isdigit() else 8)
    times["fact_build"] = round(time.perf_counter() - t0, 3)
    for name in names:  # cold: first run of each plan (includes code generation)
        t0 = time.perf_counter()
        run_query(name, spark, sf_dir, fact).collect()
        times[name] = round(time.perf_counter() - t0, 3)
    for name in TRAINING:
        t0 = time.perf_counter()
        run_query(name, spark, sf_dir, fact).collect()
        training[name] = round(time.perf_counter() - t0, 3)
    if os.environ.get("BENCH_WARM", "1") == "1":
        for name in names:  # warm: the same queries again, freshly planned
            t0 = time.perf_counter()
            run_query(name, spark, sf_dir, fact).collect()
            warm[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "headline_queries_total_wall", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
           "model_training": round(sum(training.values()), 3), "training": training}
    if warm:
        out.update(value_warm=round(sum(warm.values()), 3), queries_warm=warm)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
