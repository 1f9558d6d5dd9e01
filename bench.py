"""Benchmark the headline pipelines.

Runs each pipeline of SURVEY §2.8 (Q1-Q7) plus the fact condense at
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints ONE JSON line.  Every query is executed in full through the
``noop`` sink (no driver collect); the time is the median of
``$BENCH_REPEAT`` runs (default 3) after one warm-up pass.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = {
    "fact_condense": "fact_condense",         # A1
    "q1_fact_merge_full": "fact_merge_full",  # Q1
    "q2_fact_merge_left": "fact_merge_left",  # Q2
    "q3_fact_new_only": "fact_new_only",      # Q3
    "q4_dim_new_only": "dim_new_only",        # Q4
    "q5_project_summary": "project_summary",  # Q5
    "q6_usage_merge": "usage_merge",          # Q6
    "q7_user_usage_merge": "user_usage_merge",  # Q7
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from usagetally.plans.catalog import QUERIES
    from usagetally.session import local_session

    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8,
                          app="usagetally-bench")
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for q in HEADLINE.values():       # warm-up: JIT, file listing, codegen caches
        run(q)
    times = {k: round(median(run(q) for _ in range(repeat)), 3) for k, q in HEADLINE.items()}
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "log_rows": rows,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
