"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default: all)
BENCH_QUERIES comma-separated subset
BENCH_SECONDS after so many seconds no further query is begun (default 1200); what was not run is listed

A run that is stopped by SIGTERM or SIGINT still prints the line, with the times taken so far.
"""

from __future__ import annotations

import json
import os
import signal
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from fleetlens.catalog import QUERIES  # noqa: E402

HEADLINE = (
    "fleet_sensor_features", "fleet_sensor_profile", "sensor_stats_long", "sensor_features_wide",
    "sensor_running_state", "monotonicity", "sensor_profile", "fleet_master", "weighted_assignment",
    "stratified_folds", "fleet_scores", "dashboard_extract", "risk_tier_summary", "evaluation_by_fold",
    "threshold_sweep", "median_impute", "scaled", "category_cap", "duplicate_keys", "streaming_states", "train_rf",
    "saved_model_scores", "node_scores",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("fleetlens-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    timings: dict[str, float] = {}

    def report() -> None:
        result = {
            "metric": "total wall time of headline queries", "value": round(sum(timings.values()), 3), "unit": "sec",
            "queries": timings, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
        }
        if left := [n for n in names if n not in timings]:
            result["not_run"] = left
        if "fleet_sensor_features" in timings:
            result["feature_build_readouts_per_sec"] = round(readouts / timings["fleet_sensor_features"])
        print(json.dumps(result), flush=True)

    def stopped(signum, frame) -> None:
        report()
        os._exit(1)

    readouts = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    for number in (signal.SIGTERM, signal.SIGINT):
        signal.signal(number, stopped)
    begun, most = time.perf_counter(), float(os.environ.get("BENCH_SECONDS", "1200"))
    for name in names:
        started = time.perf_counter()
        if started - begun > most:
            break
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)
    report()
    spark.stop()


if __name__ == "__main__":
    main()
