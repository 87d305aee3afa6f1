"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  table folder, default /root/testdata/sf0.1
BENCH_CPUS    local cores, default all
BENCH_QUERIES comma-separated query names, default the headline set; "all" for every query
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from terrace.workload.queries import QUERIES

HEADLINE = (
    "fleet_metrics",
    "fleet_metrics_status",
    "fleet_metrics_cold",
    "temperature_alerts",
    "band_counts",
    "type_coercion",
    "latest_line_version",
    "latest_then_ref",
    "ref_orphans",
    "unique_violations",
    "expectations",
    "gold_tests",
    "stg_telemetry",
    "stg_orders",
    "clean_telemetry_batch",
    "watermark_changes",
    "keyed_upsert",
    "d1_increment",
    "json_roundtrip",
    "stream_ingest",
    "fact_telemetry",
    "fact_orders",
    "backup",
)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("terrace-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else [n for n in asked.split(",") if n] or HEADLINE
    spark = session()
    # Start the JVM's code paths outside the measurement.
    QUERIES["fleet_metrics"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {timings[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
