"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is forced end to end with the no-op sink (full computation, nothing collected), twice: ``queries`` has the first
run, in an otherwise warm session, ``repeat`` the second.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "asof_lookup", "pit_training_set", "feature_lookup", "training_set", "merge_upsert", "change_feed",
    "primary_key_check", "stratified_split", "impute_median", "preprocess_rows", "roc_auc", "classifier_report",
    "grouped_ols", "grouped_ols_metrics", "grouped_predict", "score_batch", "payload_split_parse",
    "champion_challenger", "profile_numeric", "drift_ks", "drift_psi", "drift_consecutive",
    "synthetic_groups", "inject_drift", "publish_latest", "profile_filter", "profile_numeric_sketch", "catalog_lookup", "tree_attribution",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from driftwood.plans import REGISTRY
    from driftwood.session import build_session
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    names = sys.argv[1:] or HEADLINE
    # warm-up: JVM start, first parquet footer reads
    REGISTRY["group_count"].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    times, again = {}, {}
    for name in names:
        for held in (times, again):
            t0 = time.perf_counter()
            REGISTRY[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            held[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "repeat": again, "repeat_total": round(sum(again.values()), 3), "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))


if __name__ == "__main__":
    main()
