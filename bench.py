"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of the tables and BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import re
import time

from gridloom.plans.catalog import QUERIES
from gridloom.session import build_session

HEADLINE = [
    "typed_cast",
    "csv_scan_typed",
    "profile_columns",
    "distinct_counts",
    "problem_strings",
    "stratified_folds",
    "exact_sample",
    "ordered_split",
    "encoded_table",
    "loo_fold_stats",
    "fold_encoded_table",
    "document_slice",
    "category_dictionary",
    "roc_auc",
    "threshold_metrics",
    "cv_mean",
    "score_histogram",
    "mean_abs_importance",
    "train_score_binary",
    "train_score_lines",
    "cv_search",
    "path_contributions",
    "shap_contributions",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/region.parquet").count()  # start the executors before timing
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        spark.catalog.clearCache()
    spark.stop()
    factor = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(factor[1]) if factor else sf_dir,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
