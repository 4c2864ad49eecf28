"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads and BENCH_RUNS the timed runs per
query, of which the fastest counts. Each query runs once before, untimed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contract.registry import REGISTRY  # noqa: E402

HEADLINE = [
    "clean_catalog",
    "clean_company_sales",
    "clean_competitor_sales",
    "dq_catalog_good",
    "dq_catalog_quarantine",
    "dq_competitor_quarantine",
    "dq_metrics",
    "latest_per_key_competitor",
    "merge_latest_sales",
    "item_dimension",
    "competitor_item_totals",
    "company_top_items",
    "competitor_top_items",
    "all_scored_candidates",
    "cleaned_recommendations",
    "recommendations",
    "recommendations_unit_price",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfgap-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(cpus)
    times = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        times[name] = round(min(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    report = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else None,
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
