"""Headline queries on one machine; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3), BENCH_QUERIES
(default the list below). Each query is run once to warm up and then BENCH_RUNS times; the median
counts. Results go to the no-op sink, so a query is computed whole and nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from checks.session import local_session
from checks.spark_queries import QUERIES

HEADLINE = os.environ.get("BENCH_QUERIES", "").split() or [
    "weekly_fact",
    "dedup_latest",
    "quality_counts",
    "explode_nested",
    "clean_price_feed",
    "clean_stock_feed",
    "gold_fact",
    "dim_date",
    "dim_product",
    "star_mart",
    "upsert_insert_update",
    "publish_upsert",
    "missing_weeks",
    "mom_change",
    "lag_corr",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus)
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
