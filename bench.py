"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventflow.plans.queries import QUERIES  # noqa: E402
from eventflow.session import build_session  # noqa: E402

HEADLINE = [
    # propagation and merge (F, G)
    "propagate_unanimous", "propagate_majority_fill", "propagate_majority_overwrite", "merge_by_priority",
    "collapse_series", "series_summary",
    # extraction (C)
    "extract_links", "resolve_ics", "dedupe_ics", "parse_vevents",
    # features (I)
    "tfidf_topk", "tfidf_pruned", "time_features",
    # keys and rules (D, E)
    "norm_url_series", "weak_label", "labelset",
    # payloads and metadata (K)
    "calendar_meta", "upsert_locations", "upsert_meta",
    # scoring (J9: fit with calibration, then score every document)
    "classify",
]


def run(spark, name, sf_dir):
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    # JVM/codegen warm-up on the smallest table set (not timed; nothing from
    # the measured tables is cached)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for n in names if os.path.isdir(warm_dir) else ["weak_label"]:
        run(spark, n, warm_dir if os.path.isdir(warm_dir) else sf_dir)
    times = {}
    for n in names:
        times[n] = round(run(spark, n, sf_dir), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
