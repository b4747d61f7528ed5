"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is timed from the call (which includes its own staging writes,
merges and runs) through full execution of the returned DataFrame into the
``noop`` sink.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from layerflow.plans.suite import QUERIES  # noqa: E402
from layerflow.session import build_session  # noqa: E402

HEADLINE = [
    "land_csv", "curate_product", "curate_customer", "dedup_composite", "gold_product_path",
    "merge_upsert", "merge_upsert_broadcast", "merge_composite_key", "merge_repeated_target", "publish_append",
    "update_where", "incremental_read", "merge_partitioned", "merge_partition_moves",
    "update_partitioned", "run_table", "run_incremental",
    "run_active", "merge_if_newer", "merge_range_pruned",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_EVENT_LOG"):
        extra.update({"spark.eventLog.enabled": "true",
                      "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]})
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), extra=extra)

    # warm-up (JVM, codegen caches) on the smallest data, not timed
    for q in ("merge_upsert", "run_table"):
        QUERIES[q](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()

    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir,
                      "cpus": cpus}))


if __name__ == "__main__":
    main()
