"""Summarise the physical plan of every registered query (used to write PLANS.md).

Usage: python tests/plan_report.py [sf_dir]  -> markdown table on stdout.
Counts come from the AQE final plan: each DataFrame is itself executed once (collected
on the JVM side), so exchange reuse and runtime re-planning are visible.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def whole_final_plan(text: str) -> str:
    """All of the final plan: what stands before the outermost (unindented) initial plan.

    Plans nested in it (cached relations) have initial plans of their own, further in.
    """
    return text.rsplit("\n+- == Initial Plan ==", 1)[0]


def summarise(plan: str) -> dict[str, int]:
    return {
        "scans": len(re.findall(r"FileScan|Scan parquet", plan)),
        "hash exch": plan.count("Exchange hashpartitioning"),
        "range exch": plan.count("Exchange rangepartitioning"),
        "single exch": plan.count("Exchange SinglePartition"),
        "reused exch": plan.count("ReusedExchange"),
        "bcast": plan.count("BroadcastExchange"),
        "BHJ": plan.count("BroadcastHashJoin"),
        "SMJ": plan.count("SortMergeJoin"),
        "aggs": plan.count("HashAggregate") + plan.count("ObjectHashAggregate"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "python": len(re.findall(r"EvalPython|InPandas", plan)),
    }


def main(argv: list[str]) -> None:
    from __spark_entry__ import queries
    from panelspark.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    from panelspark.plans import catalogue
    spark = build_session(f"local[{os.environ.get('BENCH_CPUS', '8')}]", 8)
    cols = None
    for name, fn in queries().items():
        if name not in catalogue.QUERIES:
            continue
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        df = fn(spark, sf_dir)
        built = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}"))
        df._jdf.collectAsList()
        plan = df._jdf.queryExecution().executedPlan().toString()
        first = plan.splitlines()[0]
        assert "isFinalPlan=true" in first or "AdaptiveSparkPlan" not in first, name
        s = summarise(whole_final_plan(plan))
        s["jobs built"] = built
        if cols is None:
            cols = list(s)
            print("| query | " + " | ".join(cols) + " |")
            print("|---" * (len(cols) + 1) + "|")
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)


if __name__ == "__main__":
    main(sys.argv)
