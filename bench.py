"""Benchmark: run the headline queries on local[$BENCH_CPUS] over
$BENCH_SF_DIR and print one JSON line.

Each query is forced with the ``noop`` sink (the whole plan runs, nothing is
collected). A warm-up pass runs every query once on the smallest scale
factor ($BENCH_WARM_DIR, default /root/testdata/sf0.001): the generated code
is data-independent, so the timed pass at $BENCH_SF_DIR measures warm runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from statweave.plans import registry  # noqa: E402
from statweave.plans.entity import entity_stats_once  # noqa: E402
from statweave.plans.q_ml import gbt_fit  # noqa: E402
from statweave.session import get_session  # noqa: E402

HEADLINE = [
    "entity_frame", "top_k_per_stat", "group_moments", "best_group_strengths", "histogram_by_group",
    "normalize_by_group", "wide_left_join", "wide_left_join_fanout", "mixed_agg",
    "distinct_concat", "dedupe_keep_first", "null_profile", "crosstab", "multiset_diff",
    "containment_join", "normalize_name", "sanitize_name", "html_link_extract",
    "html_table_extract", "csv_roundtrip", "fuzzy_candidates", "near_misses", "fuzzy_assign",
    "impute", "zscore", "kmeans_assign", "pca_project", "gbt_fit", "regression_metrics",
    "page_extract_status", "unmatched_entities", "kmeans_sweep", "embedding_pca",
    "embedding_kmeans",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app="statweave-bench", shuffle_partitions=cpus * 2)
    registry.load_all()
    # The entity frame that the report and ML queries share is timed by itself.
    registry.QUERIES["entity_frame"] = entity_stats_once
    # One fit at fixed parameters; gbt_predict now waits for the search of all
    registry.QUERIES["gbt_fit"] = gbt_fit
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        for name in names:
            registry.QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
