"""Time the headline queries and print one JSON line.

BENCH_SF_DIR chooses the tables, BENCH_CPUS the cores. Every query is run in full
into the noop sink, once cold and then BENCH_REPEAT times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import registry  # noqa: E402
from shelftide.session import local_session  # noqa: E402

HEADLINE = (
    "q16_top_stores", "hourly_business", "store_dashboard", "q28_peak_stockouts", "q29_potential_increase",
    "q30_store_health", "profile_target", "describe", "lag_features", "rolling_prior_mean", "rolling_prior_q25",
    "rolling_incl_median", "ewm_prior", "product_velocity", "sales_rank", "store_features", "complementary_count",
    "features_full", "seasonal_naive", "moving_average", "seasonal_profile", "business_metrics",
    "linear_ridge", "tree_random_forest", "stacked_small", "rolling_trend", "horizon_metrics", "hierarchy_forecast",
    "substitutability", "cannibalization", "residual_bias", "store_clusters",
)


def run(fn, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    keys = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, memory=os.environ.get("BENCH_MEMORY", "16g"), partitions=int(cpus) if cpus.isdigit() else 8)
    times, cold = {}, {}
    for key in keys:
        fn = registry.QUERIES[key]
        cold[key] = round(run(fn, spark, sf_dir), 3)
        times[key] = round(statistics.median(run(fn, spark, sf_dir) for _ in range(repeat)), 3)
        print(key, times[key], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "cold": cold, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
