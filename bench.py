"""Headline queries on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "outlier_labels_big", "feature_engineering", "median_impute", "dedup", "winsorize", "outlier_labels", "quality", "describe",
    "distincts", "corr_long", "corr_shift", "skew_rank", "histogram", "boxplot_stats", "top_routes", "hour_mean_sd", "grid2d",
    "route_onehot_vector", "stratified_split", "metrics_regression", "f_select", "knn_predict", "rf_holdout", "gbt_holdout",
    "kmeans_clusters",
]


def main() -> None:
    from checks.queries import QUERIES
    from millrace.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cores)
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cores)}))


if __name__ == "__main__":
    main()
