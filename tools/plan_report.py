"""Per-job physical-plan report: hash shuffles, and flags for operators that
do not scale (single-partition exchanges, nested-loop / cartesian joins,
Python UDF evaluation).  Global aggregates legitimately end in a
single-partition exchange of one partial row per task.

usage: python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from caseflow.plans.catalog import QUERIES  # noqa: E402
from caseflow.session import build_session  # noqa: E402

FLAGS = ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
         "ArrowEvalPython", "FlatMapGroupsInPandas")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 16)
    for name, q in QUERIES.items():
        plan = q(spark, sf)._jdf.queryExecution().executedPlan().toString()
        hits = [f for f in FLAGS if f in plan]
        print(f"{name:28s} shuffles={plan.count('Exchange hashpartitioning'):2d} "
              f"plan_chars={len(plan):6d} {' '.join(hits)}")


if __name__ == "__main__":
    main()
