"""Times the headline queries; prints one JSON line.

Every query is run once to warm up and then three times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hitledger.workbook import QUERIES  # noqa: E402

HEADLINE = [
    "stat_hour_ipportdomain", "stat_hour_ipport", "stat_hour_domainip", "stat_hour_domain", "stat_hour_tree",
    "stat_hour_legal_domainip", "stat_hour_illegal", "stat_day_ipportdomain", "stat_day_domain",
    "search_time_ip_range", "search_domain_port_proto", "search_url_prefix", "parse_tolerant",
    "ingest_lateness", "ingest_layout_counts", "domain_count_hybrid", "partition_missing",
    "compaction_plan", "compaction_size_classes",
]
# These write tables; one timed run each.
WRITING = [
    "ingest_idempotent", "compaction_merge", "stream_intake", "stream_hour_ipportdomain", "job_hour_domain", "job_search",
]


def seconds(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("hitledger-bench")
        .config("spark.driver.memory", "16g").config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(3)), 3)
    for name in WRITING:
        times[name] = round(seconds(spark, name, sf_dir), 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
