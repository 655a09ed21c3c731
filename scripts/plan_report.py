"""Summarise the final (adaptive) physical plan of every query of the catalog:
exchanges, join strategies, windows, Python stages and scans.  Writes a
markdown table to stdout.

usage: python scripts/plan_report.py [sf_dir]
"""
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidepanel.session import local_session  # noqa: E402

PATTERNS = {
    "exchanges": r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)",
    "broadcast_joins": r"BroadcastHashJoin",
    "smj": r"SortMergeJoin",
    "bnlj": r"BroadcastNestedLoopJoin",
    "windows": r"\bWindow\b",
    "python": r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas|FlatMapGroupsInArrow",
    "single_partition": r"SinglePartition",
}


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print("| key | exchanges | broadcast joins | sort-merge joins | nested-loop joins | windows | python stages | single-partition |")
    print("|---|---|---|---|---|---|---|---|")
    from tidepanel.plans.catalog import REGISTRY
    for k, q in sorted(REGISTRY.items()):
        df = q(spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = {n: len(re.findall(p, plan)) for n, p in PATTERNS.items()}
        print(f"| {k} | " + " | ".join(str(counts[n]) for n in PATTERNS) + " |", flush=True)


if __name__ == "__main__":
    main()
