"""Write PLANS.md: static physical-plan shape of every registered query (AQE off, so the plan is
the one Catalyst chooses before runtime re-planning).

usage: python tools/plan_summary.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from aerolake.plans import registry  # noqa: E402
from aerolake.session import get_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(master="local[8]")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    lines = ["# PLANS — static physical plan shape per registered query", "",
             f"Generated by `tools/plan_summary.py` on `{sf_dir}` with AQE off (the plan before runtime re-planning).",
             "Shuffles = hash/range/round-robin exchanges (a round-robin one spreads a split-starved scan);",
             "reused = exchanges shared between branches; SMJ/BHJ = sort-merge / broadcast-hash joins;",
             "BNLJ = nested-loop joins (only against one-row totals); partial limit = `WindowGroupLimit` before a shuffle.", "",
             "| Query | Shuffles | Reused | SMJ | BHJ | BNLJ | Partial limit | Scans | Pushed range filters |",
             "| --- | --- | --- | --- | --- | --- | --- | --- | --- |"]
    for name, q in registry.queries().items():
        plan = q(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", plan))
        pushed = sorted(set(re.findall(r"(GreaterThanOrEqual|LessThan|GreaterThan|EqualTo)\((\w+),", plan)))
        lines.append(
            f"| `{name}` | {shuffles} | {plan.count('ReusedExchange')} | {plan.count('SortMergeJoin')} | "
            f"{plan.count('BroadcastHashJoin')} | {plan.count('BroadcastNestedLoopJoin')} | "
            f"{'yes' if plan.count('WindowGroupLimit') >= 2 else ''} | {plan.count('FileScan')} | "
            f"{', '.join(f'{op}({c})' for op, c in pushed)} |")
    out = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    open(out, "w").write("\n".join(lines) + "\n")
    spark.stop()
    print(out)


if __name__ == "__main__":
    main()
