"""Headline-query timings: one JSON line on stdout.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (default 3; median reported after one warm-up run).
Each query runs to completion through the no-op sink (nothing is collected
to the driver).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rankdelta.plans.registry import load_all  # noqa: E402
from rankdelta.session import build_session, staging  # noqa: E402

HEADLINE = [
    "rank_change_daily", "rank_change_weekly", "chart_out", "baseline_resolve", "rank_report",
    "report_top_n", "highlights", "digest_text", "clean_titles", "match_keys", "rank_listing",
    "rank_change_monthly", "purge_duplicates",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(cores=cpus, shuffle_partitions=cpus)
    reg = load_all()
    timings = {}
    for name in HEADLINE:
        fn = reg[name].fn
        samples = []
        for i in range(runs + 1):
            spark.catalog.clearCache()  # every run starts from the parquet files
            t0 = time.perf_counter()
            with staging():
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                samples.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(samples), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
