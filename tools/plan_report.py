"""Summarise the physical plans of the registered queries.

Usage: python tools/plan_report.py [sf_dir] [name ...]
For each query: shuffles (Exchange), Python evaluations, window group
limits, join strategies, and the parquet read schema / pushed filters, taken
from the final adaptive plan of the execution that ran.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from webloom.functions.urls import register_functions  # noqa: E402
from webloom.plans import catalog  # noqa: E402
from webloom.session import build_session  # noqa: E402

STREAMING = {"stream_captures", "stream_unseen_urls", "stream_politeness"}


def summarise(plan: str) -> str:
    count = lambda pat: len(re.findall(pat, plan))
    shuffles = len(set(re.findall(r"Exchange (?!SinglePartition)\w+.*?\[plan_id=(\d+)\]", plan)))
    parts = [f"shuffles={shuffles}",
             f"python={count(r'ArrowEvalPython|FlatMapGroupsInPandas')}",
             f"window_group_limit={count(r'WindowGroupLimit')}",
             f"smj={count(r'SortMergeJoin')}", f"shj={count(r'ShuffledHashJoin')}",
             f"bhj={count(r'BroadcastHashJoin')}", f"bnlj={count(r'BroadcastNestedLoopJoin|CartesianProduct')}"]
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", plan)))
    pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\n]*\])", plan)))
    return " ".join(parts) + "\n    read: " + "; ".join(schemas) + ("\n    pushed: " + "; ".join(pushed) if pushed else "")


def main():
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or sorted(set(catalog.QUERIES) - STREAMING)
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    register_functions(spark)
    for name in names:
        df = catalog.QUERIES[name](spark, sf)
        df.collect()        # the frame's own execution, whose adaptive plan is then final
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "AdaptiveSparkPlan" not in plan or "isFinalPlan=true" in plan, name
        plan = plan.split("== Initial Plan ==")[0]
        print(f"{name}: {summarise(plan)}", flush=True)


if __name__ == "__main__":
    main()
