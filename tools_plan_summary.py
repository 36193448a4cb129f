"""Summarise the executed physical plan of the headline queries (for PLANS.md).

Runs each query once (so AQE's final plan is known) and counts plan nodes.
Usage: python tools_plan_summary.py [sf_dir]
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bench import HEADLINE  # noqa: E402
from ratecell.registry import QUERIES  # noqa: E402
from ratecell.session import local_session  # noqa: E402

NODES = ["Scan parquet", "Exchange hashpartitioning", "BroadcastExchange", "SortMergeJoin",
         "BroadcastHashJoin", "ShuffledHashJoin", "HashAggregate", "SortAggregate", "Window",
         "Generate", "Expand", "ReusedExchange"]


def summary(df) -> dict:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    out = {n: len(re.findall(re.escape(n), plan)) for n in NODES}
    out["PushedFilters"] = "PushedFilters: [" in plan and "PushedFilters: []" not in plan
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(app="ratecell-plans")
    print("| query | " + " | ".join(NODES) + " |")
    print("| --- " * (len(NODES) + 1) + "|")
    names = os.environ.get("PLAN_QUERIES")
    for name in (names.split(",") if names else HEADLINE):
        s = summary(QUERIES[name](spark, sf))
        print(f"| {name} | " + " | ".join(str(s[n]) for n in NODES) + " |", flush=True)


if __name__ == "__main__":
    main()
