"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query's full plan (fixture derivation from the driver's tables included)
is executed into the ``noop`` sink, so nothing is collected to the driver.
Prints one JSON line: the sum of per-query medians (seconds) and each median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlake.plans import registry  # noqa: E402
from marketlake.session import get_session  # noqa: E402

HEADLINE = [
    "parse_frames",        # PRJ-1/2: strict frame parse + dispatch
    "frame_rejects",       # FLT-2
    "flagship",            # bars: parse -> rows -> insert-ignore -> SCL-1/2
    "sink_trades",         # SNK-5
    "sink_quotes",         # SNK-1
    "policy_abort_rest",   # SNK-12
    "sink_markets",        # SRC-4 walk + PRJ-9/13 + SNK-3 upsert
    "ingest_counters",     # AGG-1
    "sink_income",         # SRC-5 + FLT-5/6 + SNK-7
    "sink_calendar",       # SRC-6 + SNK-8
    "capture_until_close",  # SRC-2
    "subscription_filter",  # SRC-3
    "pipeline_run",        # STR-1..6: frames stream run to completion (micro-batch latency included)
    "pipeline_statements",  # statements + calendar stream -> four tables
    "pipeline_markets",    # market pages stream, walk stop kept across micro-batches -> upsert
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = registry.QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = get_session(f"local[{cpus}]", app="marketlake-bench", shuffle_partitions=max(8, cpus * 2),
                        extra={"spark.driver.memory": "16g"})
    run_once(spark, names[0], sf_dir)  # warm-up (JIT, first-read caches); not reported
    medians = {}
    for name in names:
        medians[name] = round(statistics.median(run_once(spark, name, sf_dir) for _ in range(reps)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(medians.values()), 3),
                      "unit": "sec", "queries": medians, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "reps": reps, "spark": spark.version}))


if __name__ == "__main__":
    main()
