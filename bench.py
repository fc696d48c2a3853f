"""Time the headline queries on local[$BENCH_CPUS] at $BENCH_SF_DIR.

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries", "sf"}.
Each query is run to completion with the no-op sink (no collect), three
times; the reported time is the median of the three.  Before
timing, the same queries run once untimed on the smallest tables (sf0.001)
when present: that starts the Python workers and lets the JVM compile the
code paths, so the timings show steady-state cost, not JIT warm-up.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from farpoint.plans import QUERIES  # noqa: E402
from farpoint.session import local_session  # noqa: E402

REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))

HEADLINE = [
    "class_count", "class_count_two_round", "most_frequent_class",
    "word_count", "word_count_salted", "doc_term_count", "distinct_words",
    "avg_distinct_word_length",
    "max_pairwise_distance", "avg_pairwise_distance", "sample_max_distance",
    "farthest_first_centers", "nearest_center", "kcenter_max_distance",
    "partition_coreset", "greedy_pairs", "diversity_two_round", "diversity_score",
    "max_pairwise_distance_orders", "diversity_orders", "diversity_baseline_config",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="farpoint-bench")
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in names:                                     # untimed warm-up
        QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        runs = []
        for _ in range(REPEAT):
            spark.catalog.clearCache()                     # no run reads another's results
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_headline_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
