"""Print a one-line summary of the physical plan of every catalog query:
shuffles, join strategies, partial limits/aggregates and any operator that
would not scale (cartesian, nested loop, Python)."""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from costledger.plans.catalog import QUERIES  # noqa: E402
from costledger.session import build_session  # noqa: E402

MARKERS = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
           "BroadcastExchange", "BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin",
           "CartesianProduct", "BroadcastNestedLoopJoin", "WindowGroupLimit", "HashAggregate",
           "SortAggregate", "ObjectHashAggregate", "Window ", "MapInPandas", "ArrowEvalPython",
           "BatchEvalPython", "TakeOrderedAndProject", "Scan parquet"]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    spark = build_session()
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = {m.strip(): len(re.findall(re.escape(m), plan)) for m in MARKERS}
        print(f"{name:22s} " + " ".join(f"{k}={v}" for k, v in counts.items() if v))
    spark.stop()


if __name__ == "__main__":
    main()
