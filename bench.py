"""Headline queries on local Spark; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from evidara.plans import load_all  # noqa: E402
from evidara.plans.registry import QUERIES  # noqa: E402
from evidara.session import local_session  # noqa: E402

HEADLINE = [
    "candidate_rank_table", "rra_score", "rrf_score", "ablation", "weight_sensitivity", "benjamini_hochberg", "og_vote",
    "gate_loo", "interval_loci", "interval_overlap_join", "placement_cascade", "expression_stats", "tau_index",
    "nearest_ref_distance", "near_duplicate_clusters", "kmer_best_hit", "knn_novelty", "column_conservation",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", memory=os.environ.get("BENCH_MEMORY", "16g"))
    load_all()
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
