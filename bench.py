"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's full plan is executed into Spark's ``noop`` sink (every row is
produced, nothing is collected to the driver).  ``publish_all`` runs the whole
job: land six raw tables, register them, publish twelve tables;
``feature_job`` times the twelve-table job alone over already landed raw
tables.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartlake.plans import registry  # noqa: E402
from cartlake.plans.feature_job import FeatureJob  # noqa: E402
from cartlake.plans.registry import QUERIES  # noqa: E402
from cartlake.session import build_session, workspace  # noqa: E402
from cartlake.sinks.versioned import VersionedTables  # noqa: E402

HEADLINE = [
    "order_products_prior", "user_features_1", "user_features_2", "up_features", "prd_features",
    "product_seq_time", "normalize_bool_flag", "order_products_union", "merge_upsert", "apply_changes",
    "check_primary_key", "check_composite_key", "check_orphans", "publish_all",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    sf = float(m.group(1)) if m else None
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):   # stage / task times without the web UI
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]}
    spark = build_session(master=f"local[{cpus}]", app_name="cartlake-bench", shuffle_partitions=cpus,
                          extra=extra)
    # Warm-up: JVM class loading, code generation and JIT are not query time.
    # Done on the smallest generated scale when present (other files, other
    # cached statistics), so nothing the timed queries read is pre-loaded.
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if not os.path.isdir(warm_dir) or os.path.abspath(warm_dir) == os.path.abspath(sf_dir):
        warm_dir = sf_dir
    for key in ("user_features_1", "order_products_prior"):
        QUERIES[key](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times, failed = {}, []
    for key in HEADLINE:
        spark.sparkContext.setJobDescription(key)
        t0 = time.perf_counter()
        try:
            QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[key] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # one failing query must not lose the other timings
            print(f"bench: {key} failed: {e}", file=sys.stderr)
            times[key] = None
            failed.append(key)
    # The raw -> silver job alone: landing the raw tables is not timed.
    try:
        root = workspace(spark, "bench-job")
        raw_db = registry._land_raw(spark, sf_dir, root)
        spark.sparkContext.setJobDescription("feature_job")
        t0 = time.perf_counter()
        FeatureJob(spark, raw_db, VersionedTables(spark, f"{root}/silver", "bench_silver")).run()
        times["feature_job"] = round(time.perf_counter() - t0, 3)
    except Exception as e:
        print(f"bench: feature_job failed: {e}", file=sys.stderr)
        times["feature_job"] = None
        failed.append("feature_job")
    spark.stop()
    out = {"metric": "headline_queries_total",
           "value": round(sum(t for t in times.values() if t is not None), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
