"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built and fully executed (``write.format("noop")``: every
partition computed, nothing sent to the driver). A query runs once cold and
then ``BENCH_REPEAT`` times warm; the reported time is the best warm run.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panel_edit.plans.catalog import QUERIES  # noqa: E402
from panel_edit.session import build_session, ensure_checkpoint_dir  # noqa: E402

HEADLINE = [
    "e1_preprocess", "e2_adjust", "e3_mapping",
    "w3_zscore", "d2_iqr", "d5_constrain", "d9_extrapolate", "d13_rollback_years", "r3_metrics_wide",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session("panel_edit_bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="panel-edit-bench-", dir="/tmp"))
    cold, warm = {}, {}
    for name in names:
        cold[name] = round(run(spark, name, sf_dir), 3)
        warm[name] = round(min(run(spark, name, sf_dir) for _ in range(max(repeat, 1))), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "headline_queries_total_warm",
        "value": round(sum(warm.values()), 3),
        "unit": "sec",
        "queries": warm,
        "cold": cold,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus),
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
