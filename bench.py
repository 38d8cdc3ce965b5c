"""Headline queries, timed: prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from checks.catalog import QUERIES

HEADLINE = [
    "fact_stock_daily", "industry_daily_price", "industry_return_pct", "market_obt", "merge_markets", "explode_flatten",
    "filter_official", "missing_anti", "clean_gap_scan", "sentiment_asof", "completeness_b", "unparseable_scan",
    "dim_date", "backlog_dates", "industry_ranking_latest", "latest_vs_previous", "job_quality_gates", "job_articles",
    "incremental_replace", "sink_backfill_union_once",
]
# One query for each set of inputs that is written once: raw tables, payloads, clean lake, marts.
WARM_UP = ["dim_date", "merge_markets", "explode_flatten", "scan_clean_partitioned", "stock_info"]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Inputs that queries share are written, and code is compiled, before the clock starts.
    for name in WARM_UP:
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
