"""Print the physical shape of every registered query (the final plan of the
returned DataFrame, after the writes the query performs).

Usage: python tests/plan_report.py [sf_dir]
Columns: shuffles (Exchange nodes other than broadcasts), broadcasts,
Python operators (mapInPandas / Python UDF), scans and their pushed filters.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def shape(plan: str) -> dict[str, object]:
    lines = plan.splitlines()
    shuffles = [ln for ln in lines if re.search(r"\bExchange (hashpartitioning|rangepartitioning|"
                                               r"RoundRobinPartitioning|SinglePartition)", ln)]
    reused = sum("ReusedExchange" in ln for ln in lines)
    broadcasts = sum("BroadcastExchange" in ln for ln in lines)
    python = sum(bool(re.search(r"MapInPandas|BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas", ln))
                 for ln in lines)
    kinds = sorted({re.search(r"Exchange (\w+)", ln).group(1) for ln in shuffles})
    pushed = [m.group(1) for m in re.finditer(r"(?:PushedFilters|PartitionFilters): \[([^\]]*)", plan)
              if m.group(1).strip()]
    return {"shuffles": len(shuffles), "kinds": ",".join(kinds), "reused": reused,
            "broadcasts": broadcasts, "python": python, "pushed": len(pushed)}


def main(argv):
    from loadbay.plans import PLANS
    from loadbay.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    print("| query | shuffles | kinds | broadcasts | Python operators | pushed or partition filters |")
    print("| --- | --- | --- | --- | --- | --- |")
    for key, fn in PLANS.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = shape(plan)
        print(f"| {key} | {s['shuffles']} | {s['kinds'] or '-'} | {s['broadcasts']} | "
              f"{s['python']} | {s['pushed']} |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
