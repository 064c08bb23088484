"""Headline queries, timed once each after a warm-up of the session.

Prints one JSON line.  BENCH_SF_DIR and BENCH_CPUS choose data and cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "b2_cleaning_audit", "b17_basic_cleaning", "c21_build_features", "e1_stratified_split", "f11_complete_grid", "g1_describe",
    "g9_rate_by_commodity_year", "g14_box_stats", "g18_latency_histogram", "h1_percentile_rank", "i8_classification_report",
    "i11_threshold_scan", "i12_roc_auc", "i19_metric_table", "d5_d6_assembled_features", "j1_glm_by_level", "j6_final_refit",
    "j7_poisson_tree", "j8_complexity_table", "j12_poisson_booster", "j22_evaluate_parts", "e9_adaptive_oversampling",
    "k1_batch_score", "l2_usage_per_window",
)


def main() -> None:
    from ratewell.plans.catalog import registry
    from ratewell.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry().queries
    names = sys.argv[1:] or HEADLINE
    queries["g9_rate_by_commodity_year"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
