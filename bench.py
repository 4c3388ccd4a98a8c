"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all cores) and
BENCH_RUNS (default 3; the median counts, after one warm-up) set what is run.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from winback.plans import all_queries
from winback.session import configure

HEADLINES = (
    "clean_silver",
    "quality_report",
    "explore_days_between_purchases",
    "explore_monthly_activity",
    "population_target_rate",
    "features_modeling_base",
    "features_windowed_base",
    "metric_table_by_split",
    "score_table",
    "batch_customer_profiles",
    "batch_product_share",
    "monitor_feature_drift",
    "monitor_round_summary",
    "explain_global_importance",
    "model_logistic_metrics",
    "batch_gate",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    builder = SparkSession.builder.master(f"local[{cores}]").appName("winback-bench")
    builder = (
        builder.config("spark.sql.shuffle.partitions", cores)
        .config("spark.ui.enabled", "false")
        # The lines of sf0.1 are one file with one row group.
        .config("spark.winback.pieces", cores)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = all_queries(), {}

    def run(name: str) -> float:
        start = time.perf_counter()
        # Every row and column is computed, none is kept.
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for name in HEADLINES:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cores),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
