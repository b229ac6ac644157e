"""Summarize the executed (AQE final) physical plan of every registered query.

Usage: python tools/plans.py [sf_dir] > PLANS.md
Per key: shuffles by kind, join strategies, aggregate stages, and the columns
each Parquet scan reads.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def summarize(plan: str) -> dict[str, str]:
    def n(pat: str) -> int:
        return len(re.findall(pat, plan))

    shuffles = []
    for kind, pat in [
        ("hash", r"Exchange hashpartitioning"),
        ("range", r"Exchange rangepartitioning"),
        ("round-robin", r"Exchange RoundRobinPartitioning"),
        ("single", r"Exchange SinglePartition"),
    ]:
        if n(pat):
            shuffles.append(f"{n(pat)} {kind}")
    joins = []
    for kind in ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct"):
        if n(kind):
            joins.append(f"{n(kind)} {kind}")
    reused = n(r"ReusedExchange")
    scans = sorted(set(re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan)))
    scans = ["(" + ", ".join(c.split("#")[0] for c in s.split(",")) + ")" for s in scans]
    other = [k for k in ("TakeOrderedAndProject", "Expand", "Generate", "Scan ExistingRDD", "WholeStageCodegen") if k in plan]
    return {
        "shuffles": ", ".join(shuffles) or "none",
        "joins": ", ".join(joins) or "none",
        "aggregates": str(n(r"HashAggregate\(") + n(r"SortAggregate\(") + n(r"ObjectHashAggregate\(")),
        "reused": str(reused),
        "scans": "; ".join(scans),
        "other": ", ".join(other),
    }


def main(argv: list[str]) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from stationflow.plans.registry import queries
    from stationflow.session import build_session

    spark = build_session("local[8]")
    print(f"# Executed plans ({sf_dir}, local[8], AQE final plans)\n")
    print("Generated by `python tools/plans.py`. Stream keys show the plan that reads the sink back.\n")
    print("| key | shuffles | joins | agg nodes | scans (columns read) | notes |")
    print("|---|---|---|---|---|---|")
    for key, q in queries().items():
        df = q(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarize(plan)
        print(f"| `{key}` | {s['shuffles']} | {s['joins']} | {s['aggregates']} | {s['scans']} | {s['other']} |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
