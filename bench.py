"""Seconds per query of the catalogue, warm session, median of three; one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time
from pathlib import Path

from tidemark.plans import catalogue
from tidemark.session import local_session

#: Queries whose figures stand for their operators.
HEADLINE = [
    "pure_windows", "pure_windows_long", "window_yield", "run_stats_p95", "gap_detect", "time_order", "sampling_rate", "trim_to_window_multiple", "sliding_windows",
    "dtype_recommend", "parse_number", "label_encode_sorted", "features_q", "features_s", "anova_f", "one_vs_rest", "source_outlier", "closest_class", "threshold_segments",
    "nms_centers", "regrid_linear", "downsample_fir", "consecutive_n", "majority_vote", "production_pipe", "rules_findings",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("tidemark-bench", cpus, 8 if cpus == "*" else max(4, int(cpus)))
    spark.sparkContext.setLogLevel("ERROR")
    took: dict[str, float] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(3):
            start = time.perf_counter()
            catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        took[name] = round(statistics.median(runs[1:]), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
