"""Summarise the executed (AQE final) physical plan of every registered query.

Usage: python tools/plan_summary.py [sf_dir] [name ...]  -> a markdown table on stdout.
Per query: shuffles, broadcasts, join strategies, partial aggregations / group limits, and
whether any nested-loop or Cartesian join appears.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillstar.queries import QUERIES  # noqa: E402
from tillstar.session import build_session  # noqa: E402


def summarise(plan: str) -> dict:
    joins = set()
    for line in plan.splitlines():
        m = re.search(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", line)
        if m:
            t = re.search(r"\b(Inner|LeftOuter|RightOuter|FullOuter|LeftAnti|LeftSemi|Cross|ExistenceJoin)\b", line)
            joins.add(f"{m.group(1).replace('Join', '')}:{t.group(1) if t else '?'}")
    return {
        "shuffles": len(re.findall(r"\bExchange (hash|range|Single|RoundRobin)", plan)),
        "reused": plan.count("ReusedExchange"),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": ", ".join(sorted(joins)) or "-",
        "partial agg": len(re.findall(r"partial_", plan)) > 0,
        "group limit": "WindowGroupLimit" in plan,
        "nested loop / cartesian": ("BroadcastNestedLoopJoin" in plan) or ("CartesianProduct" in plan),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("local[8]", 8)
    print("| query | shuffles | broadcasts | joins | partial agg | top-1 limit | NLJ/cartesian |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['joins']} | {'yes' if s['partial agg'] else 'no'} "
              f"| {'yes' if s['group limit'] else 'no'} | {'YES' if s['nested loop / cartesian'] else 'no'} |",
              flush=True)


if __name__ == "__main__":
    main()
