"""Headline queries at one scale; prints one JSON line with the seconds of each.

Each query runs once after the session has been warmed up; progress goes to standard error.
Queries that apply a model load it from the store; ``train_score_rf`` fits and stores it.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from delaylens.plans import QUERIES  # noqa: E402

LIGHT = (
    "punctuality_kpis", "totals_by_month", "top_routes", "delay_by_hour", "null_counts",
    "histogram_edges", "share_of_total", "join_coverage", "fleet_per_carrier", "flights_per_airplane",
    "resolve_names", "nearest_station", "nearest_observation", "flight_weather", "publish_flights", "index_flights", "search_flights",
    "base_features", "features_full", "string_index", "classification_metrics", "regression_metrics",
)
HEAVY = ("train_score_rf", "train_score_regression", "batch_score_day", "stream_score")


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds(spark, "row_counts", folder)
    times = {}
    for name in LIGHT + HEAVY:
        times[name] = round(seconds(spark, name, folder), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
