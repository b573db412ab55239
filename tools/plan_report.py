"""Summarise the final physical plan of every registered query (after execution, so AQE
decisions such as broadcast conversion and exchange reuse are visible).

    python tools/plan_report.py [--sf /root/testdata/sf0.01] > PLANS.md
"""

from __future__ import annotations

import argparse
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesforge.session import ensure_checkpoint_dir, get_session  # noqa: E402

COUNTERS = [
    ("scans", r"FileScan|Scan JDBC"),
    ("settled", r"Scan ExistingRDD"),
    ("shuffles", r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)"),
    ("broadcasts", r"BroadcastExchange"),
    ("reused", r"Reused"),
    ("bhj", r"BroadcastHashJoin"),
    ("smj", r"SortMergeJoin"),
    ("cartesian/nlj", r"(?:CartesianProduct|BroadcastNestedLoopJoin)"),
    ("windows", r"\bWindow\b"),
    ("top-k", r"TakeOrderedAndProject"),
    ("expand", r"\bExpand\b"),
]


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    a = ap.parse_args()
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="sf-plans-"))  # a local run
    from salesforge.plans import registry

    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_report.py` at `{a.sf}`: counts of operators in each query's final "
          "(post-AQE) physical plan. Operators that compute statistics or settle shared aggregates first "
          "(quantiles, sigma filters, quality counts, product totals) run those as jobs of their own before: "
          "their number is in the last column; `settled` are reads of such a result.\n")
    print("| query | " + " | ".join(n for n, _ in COUNTERS) + " | jobs before |")
    print("|---|" + "---|" * (len(COUNTERS) + 1))
    for name, fn in registry.queries().items():
        spark.sparkContext.setJobGroup(name, name)
        df = fn(spark, a.sf)
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(rx, plan)) for _, rx in COUNTERS]
        print(f"| `{name}` | " + " | ".join(str(c) for c in [*counts, before]) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
