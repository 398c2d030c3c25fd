"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the data and local[n].
Every query runs to the end through the no-op sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "payment_format_rates", "base_features", "history_full", "account_features", "retro_graph", "pagerank",
    "chrono_split", "stratified_folds", "average_precision", "metrics_by_split", "threshold_sweep",
    "paired_bootstrap", "mutual_information", "txn_cluster_profile",
    "logistic_scores", "tree_scores", "forest_scores", "gbt_scores",
]


def main() -> None:
    from flowsieve.plans import registry
    from flowsieve.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", "bench", **{"spark.sql.shuffle.partitions": cpus})
    queries = registry.queries()
    queries["base_rate"](spark, sf_dir).collect()  # start-up, file listing
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
