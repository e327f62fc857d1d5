"""Headline-query benchmark.

Runs the headline queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Every query is executed in full with the ``noop`` sink (all rows produced,
none collected).  Before timing, every measured query runs once on the tiny
sf0.001 tables (when present), so JIT and whole-stage-codegen compilation of
each plan shape and Python-worker start-up are not charged to the timed run.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "cosine_topn",
    "cosine_topn_excluding_seen",
    "recommend_batch_variable_n",
    "hit_rate",
    "holdout_split",
    "query_vector_table",
    "playlist_items",
    "dedup_by_key",
    "first_seen_per_slice",
    "upsert_latest",
    "three_way_inner_sorted",
    "enrich_in_batches",
    "progress_counts",
    "select_playlist_features",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = sys.argv[1:]
    from setlist.session import build_session
    from setlist.plans.registry import all_queries

    spark = build_session(f"local[{cpus}]", app="setlist-bench", shuffle_partitions=2 * cpus,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    qs = all_queries()
    names = only or HEADLINE
    warm_dir = "/root/testdata/sf0.001"
    if os.path.isdir(warm_dir) and warm_dir != sf_dir:
        for name in names:
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))


if __name__ == "__main__":
    main()
