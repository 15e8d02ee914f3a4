"""Wall time of the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from propensity.plans.catalogue import QUERIES  # noqa: E402

HEADLINE = (
    "rank_orders",
    "top_100",
    "dedup_lines",
    "duplicate_counts",
    "target_conflicts",
    "clean_good_rows",
    "validation_counts",
    "quarantine_rows",
    "cardinality",
    "rare_categories",
    "outlier_counts",
    "monthly_rate",
    "decile_rate",
    "effect_screen",
    "exact_deciles",
    "split_rows",
    "split_summary_orders",
    "probability_metrics",
    "threshold_report",
    "capacity_table",
    "score_threshold",
    "bootstrap_intervals",
    "compare_scorers",
    "numeric_psi",
    "categorical_psi",
    "drift_report",
    "median_impute",
    "standardize",
    "one_hot_infrequent",
    "spline_basis",
    "stored_scores",
    "ingest_numbered_text",
    "constraint_violation_counts",
    "logistic_scores",
    "gradient_boosting_scores",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("propensity-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["tier_counts"](spark, sf_dir).count()  # start-up and code generation are not measured
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
