"""Summarise the plans that ran for the registered queries into PLANS.md.

Usage: python tools/plan_report.py [sf_dir]
Every query is executed (no rows are collected) and the final plan is walked
node by node, query stages and scalar subqueries included: shuffles,
single-partition exchanges, broadcasts, join strategies, windows and scans.  A
reused exchange counts once.  What a query stores on its way (see
``odflow.session.stored``) ran before and is not part of its last plan.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

sys.path.insert(0, ".")
from odflow.queries import registry  # noqa: E402
from odflow.session import local_session  # noqa: E402

COLUMNS = ["shuffles", "single", "broadcasts", "bhj", "smj", "nlj", "window", "scans", "partition_filters", "pushed_filters"]


def seq(s) -> list:
    return [s.apply(i) for i in range(s.size())]


def nodes(plan):
    """All nodes of a physical plan that ran."""
    yield plan
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        below = [plan.executedPlan()]
    elif name.endswith("QueryStage"):
        below = [plan.plan()]
    else:
        below = seq(plan.children())
    for child in below + seq(plan.subqueries()):
        yield from nodes(child)


def summary(df) -> Counter:
    query = df._jdf.queryExecution()
    query.toRdd().count()
    out: Counter = Counter()
    for node in nodes(query.executedPlan()):
        name, text = node.nodeName(), node.simpleString(10_000)
        if name == "Exchange":
            out["single" if "SinglePartition" in text else "shuffles"] += 1
        out["broadcasts"] += name == "BroadcastExchange"
        out["bhj"] += name == "BroadcastHashJoin"
        out["smj"] += name in ("SortMergeJoin", "ShuffledHashJoin")
        out["nlj"] += name in ("BroadcastNestedLoopJoin", "CartesianProduct")
        out["window"] += name == "Window"
        if name.startswith("Scan "):
            out["scans"] += 1
            out["partition_filters"] += bool(re.search(r"PartitionFilters: \[[^\]]", text))
            out["pushed_filters"] += bool(re.search(r"PushedFilters: \[[^\]]", text))
    return out


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8, "odflow-plans")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    lines = [
        "# PLANS", "", f"Final plans of the registered queries on `{sf_dir.rstrip('/').rsplit('/', 1)[-1]}`, as executed, scalar subqueries included",
        "(`python tools/plan_report.py`). What a query stores on its way ran before and is not counted.", "",
        "| query | " + " | ".join(COLUMNS) + " |", "|---|" + "---:|" * len(COLUMNS)]
    for name, fn in sorted(registry().items()):
        s = summary(fn(spark, sf_dir))
        lines.append(f"| {name} | " + " | ".join(str(s[c]) for c in COLUMNS) + " |")
        print(lines[-1], flush=True)
    with open("PLANS.md", "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


if __name__ == "__main__":
    main()
