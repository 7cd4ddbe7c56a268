"""Runs the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
HEADLINE = (
    "frame_counts", "primary_market_mode", "top_of_book", "book_step_audit", "depth_histograms", "hist_percentile", "latest_per_asset", "interval_hist", "bar_coverage",
    "coverage_grouping_sets", "asof_snapshot", "leader_pick", "roi_by_bucket", "roi_cumulative", "settle_agreement", "inventory_diff", "growing_vs_real", "dup_audit",
    "set_algebra", "dedup_window", "gap_islands", "regex_timeline",
)


def main() -> None:
    from tapeworks.plans.catalogue import queries
    from tapeworks.session import local_session

    d, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, cpus, "bench", "8g")
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):  # the first one warms up
            t = time.perf_counter()
            queries()[name](spark, d).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t)
        took[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": d.rsplit("sf", 1)[-1], "cpus": cpus, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
