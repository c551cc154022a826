"""Benchmark: runs the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed in full into Spark's ``noop`` sink (no collect to the
driver). A warm-up query runs first so JVM start-up and code loading are not
counted. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "interpretable_metrics",
    "topic_metrics",
    "aacc_per_author",
    "author_overlap_pairs",
    "impact_index",
    "impulse_index",
    "embed_documents",
    "knn_cosine",
    "mutual_reachability",
    "attach_periphery",
    "hdbscan",
    "best_pubs",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from pubstrata.session import local_session
    from pubstrata.plans.registry import QUERIES

    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2), app="pubstrata-bench")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in QUERIES]
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for w in ("aacc", "knn_cosine"):  # warm-up, not timed
        QUERIES[w](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
