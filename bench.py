"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the number of local cores and
BENCH_RUNS how often each query runs (the median counts). Results go to a sink
that drops them.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from runatlas.plans.catalog import QUERIES
from runatlas.session import get_spark

HEADLINE = (
    "build_warehouse",
    "executive_kpis",
    "model_leaderboard",
    "dataset_comparison",
    "framework_comparison",
    "gpu_performance",
    "hyperparameter_analysis",
    "training_timeline",
    "source_breakdown",
    "validate_valid",
    "etl_funnel",
    "dedup_first",
    "missing_metrics_median",
    "fact_training_run",
    "dim_upsert_second_load",
    "recent_predictions",
    "monitored_models",
    "latency_summary",
    "latency_history",
    "volume_per_minute",
    "drift_check",
    "drift_status",
    "tracked_runs_to_records",
    "weighted_loss",
    "final_epoch",
    "macro_prf",
    "sample_n",
    "stream_ingest_dedup",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    only = os.environ.get("BENCH_QUERIES")
    names = only.split(",") if only else HEADLINE
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["executive_kpis"](spark, sf_dir).collect()  # warms up and builds the star
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
