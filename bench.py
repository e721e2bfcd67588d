"""Seconds per headline query; prints one JSON line.

BENCH_SF_DIR   folder of the parquet tables (default sf0.1)
BENCH_CPUS     local cores (default all)
BENCH_QUERIES  comma-separated names instead of the headline list
"""

from __future__ import annotations

import json
import os
import sys
import time

from assayer.plans import catalog
from assayer.session import local_session

HEADLINE = [
    "p02_describe", "p04_target_distribution", "p06_split_shares", "p07_drop_duplicates", "p11_compare_stats", "p13_class_box",
    "v01_histogram", "v02_kde", "v06_corr_triangle",
    "r07_poly2", "r08_bundle_ratios_and_logs", "r11_class_probabilities",
    "o01_iqr_bounds", "o02_iqr_filter", "o04_iqr_sequential", "o07_zscore_filter", "o08_isolation_forest",
    "m02_fill_train_mean", "f01_scale_standard", "f03_scale_robust", "f05_quantile_uniform", "f06_yeo_johnson",
    "c01_corr_long", "c07_vif_all", "c10_pair_search", "c17_pareto",
    "l03_f_regression", "l04_f_classif", "l05_mutual_information",
    "t02_stratified_split", "t04_stratified_folds", "t07_smote", "t11_random_oversample", "a10_knn_regressor",
    "a01_linear_regression", "a04_forest_regressor", "t06_cross_validate",
    "e01_regression_metrics", "e04_class_report", "e05_qwk", "e06_macro_auc", "e12_linear_shap",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "*"), "assayer-bench")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
