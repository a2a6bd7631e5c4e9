"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line.  Every query is executed in
full into Spark's ``noop`` sink (no rows are collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.operators.parallel import SPREAD_SETTING  # noqa: E402
from tidemark.plans.queries import REGISTRY  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "extract_pages",
    "chunk_pages",
    "diff_chunks",
    "change_summary",
    "index_apply_changes",
    "site_bfs_with_sitemap",
    "llms_full",
    "contract_violations",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in (sys.argv[1:] or HEADLINE) if n in REGISTRY]
    spark = build_session(f"local[{cpus}]", int(cpus) * 2, app_name="tidemark-bench",
                          extra={"spark.driver.memory": "16g", SPREAD_SETTING: cpus})  # the test tables are single-split files
    # warm-up, not timed: the same queries once on the smallest tables (JIT, codegen caches)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm_dir):
        for name in names:
            REGISTRY[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
