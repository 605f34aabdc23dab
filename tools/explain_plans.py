"""Print physical plans of registered queries (after execution, so AQE's final plan shows).

Usage: python tools/explain_plans.py [sf_dir] name [name ...]
Prints a count of exchanges, broadcasts, windows and joins per query, then the
formatted plan. Cached relations are shown by Spark with their source plan.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from panel_edit.plans.catalog import QUERIES  # noqa: E402
from panel_edit.session import build_session, ensure_checkpoint_dir  # noqa: E402

NODES = ("Exchange hashpartitioning", "Exchange rangepartitioning", "BroadcastExchange", "Window ",
         "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin", "HashAggregate", "FileScan parquet",
         "InMemoryTableScan", "Scan ExistingRDD")


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or ["w3_zscore"]
    spark = build_session("panel_edit_explain", master="local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="panel-edit-explain-", dir="/tmp"))
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        # Only the query's own plan: cached relations print their source plan indented below them.
        own = []
        for line in plan.split("\n"):
            if "InMemoryRelation" in line:
                own.append(line)
                break
            own.append(line)
        text = "\n".join(own)
        counts = {n.strip(): len(re.findall(re.escape(n), text)) for n in NODES}
        print(f"== {name}: " + ", ".join(f"{k} {v}" for k, v in counts.items() if v))
        print(text)


if __name__ == "__main__":
    main()
