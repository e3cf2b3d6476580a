"""Benchmark the headline plans.

Runs each plan on $BENCH_SF_DIR (default /root/testdata/sf0.1) with
local[$BENCH_CPUS]; every plan is executed once to warm up, then timed
$BENCH_REPS times (median reported).  Execution uses the ``noop`` sink,
so the whole plan runs but nothing is collected.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "customer_month_features", "segment_label_summary", "table_profile", "fk_violations",
    "monthly_aum_sum", "asset_composition", "asset_histogram", "holding_percent",
    "roc_auc", "pr_auc", "classification_report",
    "frequent_itemsets", "association_rules",
    "series_summary", "ar_forecast", "dickey_fuller", "acf",
    "cluster_profile_mode", "segment_share", "nearest_centroid", "silhouette_sq",
    "contribution_summary", "waterfall", "gini_best_split",
    "segment_quartiles", "median_fill", "dashboard_bundle", "arima_fit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    scratch = tempfile.mkdtemp(prefix="custlens-bench-")

    from custlens.session import get_session
    from custlens.plans import REGISTRY

    spark = get_session(f"local[{cpus}]", "custlens-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "16g", "spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    names = only or HEADLINE
    timings: dict[str, float] = {}
    for name in names:
        build = REGISTRY[name].build
        build(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        runs = []
        for _ in range(reps):
            t0 = time.perf_counter()
            build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 4)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(timings.values()), 4),
                      "unit": "sec", "queries": timings, "sf": sf, "cpus": int(cpus), "reps": reps}))


if __name__ == "__main__":
    main()
