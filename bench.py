"""Headline-query benchmark: prints one JSON line.

Runs the registered queries on $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS]; each query is fully materialised with the no-op sink
(every column computed, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from folio.plans.catalog import QUERIES  # noqa: E402
from folio.session import build_session  # noqa: E402

HEADLINE = ["extract_listing", "insert_if_absent", "chunk_text", "embed_chunks", "knn_topk_batch",
            "extract_links", "dedupe_links", "ledger_state", "corpus_profile", "vector_entry"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus) * 2)
    names = sys.argv[1:] or HEADLINE
    # warm-up on the smallest scale: JVM JIT, codegen caches, Python workers and the
    # per-session expression trees (a fixed driver cost, independent of data size)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in names:
        if os.path.isdir(warm_dir):
            QUERIES[name](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_headline_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
