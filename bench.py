"""Benchmark the headline queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 2: a cold and a warm run per query), BENCH_EXPLAIN=1
(print each query's formatted physical plan to stderr).
Each query is fully evaluated with the ``noop`` sink (nothing is collected).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "curate_corpus",        # C1, C2/C3, F1-F5, D1
    "curation_funnel",      # A2
    "near_dup_groups",      # J3, D2, D3
    "grouped_split",        # D4
    "label_table",          # M3 (scoring every document)
    "label_posts",          # E1-E3, M7 (extraction + labelling)
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    from textlens.session import build_session
    spark = build_session(f"local[{cpus}]", app="textlens-bench", shuffle_partitions=cpus * 2,
                          extra={"spark.ui.showConsoleProgress": "false"})
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textlens-bench-"))
    from textlens.plans.catalog import QUERIES

    explain = os.environ.get("BENCH_EXPLAIN") == "1"
    cold, warm = {}, {}
    for name in HEADLINE:
        if explain:
            mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
            plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().explainString(mode)
            print(f"== {name} ==\n{plan}", file=sys.stderr)
        times = []
        for _ in range(repeat):
            t0 = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(round(time.time() - t0, 3))
        cold[name] = times[0]
        warm[name] = min(times[1:]) if len(times) > 1 else times[0]
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_warm",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
