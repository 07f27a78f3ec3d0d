"""Physical-plan summary of every registered query (writes PLANS.md).

Usage: python tools/plan_report.py [SF_DIR] > PLANS.md

Per key: shuffles (Exchange hashpartitioning / rangepartitioning / single
partition), broadcasts, aggregate kinds, window group limits, whole-stage
codegen spans, and any operator that should never appear at scale
(CartesianProduct, BroadcastNestedLoopJoin, Python evaluation).  Keys whose
work happens while building (file pipeline, incremental writes) show the
plan of the final read only.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from payerlake.session import build_session  # noqa: E402

PATTERNS = {
    "shuffle": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange RoundRobin|Exchange SinglePartition",
    "single_partition": r"Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "hash_agg": r"\bHashAggregate",
    "object_hash_agg": r"ObjectHashAggregate",
    "sort_agg": r"SortAggregate",
    "window": r"\bWindow \[",
    "window_group_limit": r"WindowGroupLimit",
    "take_ordered": r"TakeOrderedAndProject",
    "codegen_stages": r"\*\(\d+\)",
    "bad:cartesian": r"CartesianProduct",
    "bad:nested_loop": r"BroadcastNestedLoopJoin",
    "bad:python": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
}


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from payerlake.plans.registry import load_all
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan shape
    qs = {k: e.build for k, e in load_all().items()}
    print("# Physical plan summary per query key\n")
    print(f"Generated by `tools/plan_report.py` on `{sf}` with AQE off (static plan shape; at run time AQE")
    print("may turn a sort-merge join into a broadcast after measuring, coalesce partitions and split skew).\n")
    cols = list(PATTERNS)
    print("| key | " + " | ".join(c.replace("bad:", "") for c in cols) + " |")
    print("|---|" + "---|" * len(cols))
    bad_total = 0
    for k in qs:
        try:
            plan = qs[k](spark, sf)._jdf.queryExecution().executedPlan().toString()
        except Exception as e:  # noqa: BLE001
            print(f"| {k} | error: {type(e).__name__} |")
            continue
        counts = [len(re.findall(p, plan)) for p in PATTERNS.values()]
        bad_total += sum(c for name, c in zip(cols, counts) if name.startswith("bad:"))
        print(f"| {k} | " + " | ".join(str(c) for c in counts) + " |")
    print(f"\nOperators that must not appear (cartesian, nested loop, python): {bad_total} in total.")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
