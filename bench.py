"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with the ``noop`` sink (every row computed,
nothing collected). The stand-in inputs shared by the queries (profiles,
cluster matrices) are built and checkpointed first and timed separately as
``standins``. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from audix.plans import catalog as C  # noqa: E402
from audix.session import build_session, checkpoint_dir  # noqa: E402

HEADLINE = [
    "segment_topk", "segment_members", "expand_users", "expand_by_segment", "expansion_minus_seed",
    "expansion_counters", "audience_compare", "audience_revenue_hourly", "features_long", "graph_lines",
    "training_rows", "jaccard_pairs", "graph_edges", "modularity_of", "community_affinity", "admit_users",
    "final_audience", "learn_weights", "kfold_sizes", "communities_label_prop", "communities_greedy",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:]
    spark = build_session(f"local[{cpus}]", app="audix-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": "16g"})
    checkpoint_dir(spark)
    times: dict[str, float] = {}
    t0 = time.time()
    for fn in (C.profiles, C.user_clusters, C.cluster_users, C.segment_revenue):
        fn(spark, sf_dir)
    times["standins"] = round(time.time() - t0, 3)
    for name in HEADLINE:
        if only and name not in only:
            continue
        t0 = time.time()
        C.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
