"""Print the formatted physical plans of the headline queries and a summary.

    python tools/explain_plans.py [sf_dir] [query ...]

For each query: number of exchanges by kind, broadcasts, Python stages and the
ReadSchema / PushedFilters of every parquet scan, then the full formatted plan
(``DataFrame.explain("formatted")``) when ``--full`` is given. Building a query
runs the eager checkpoint jobs of its rankings, as in normal use.
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from shelfwise.plans.recplan import RecPlan  # noqa: E402
from shelfwise.session import build_session  # noqa: E402

HEADLINE = ("item_features", "split_assignment", "examples", "text_examples", "prompts_text_multi", "scored_ranking")


def summarize(name: str, plan_text: str) -> str:
    lines = [f"## {name}"]
    kinds = re.findall(r"Arguments: (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)",
                       plan_text)
    counts = {k: kinds.count(k) for k in sorted(set(kinds))}
    lines.append(f"- shuffle exchanges: {sum(counts.values())} {counts}")
    details = plan_text.split("\n\n", 1)[-1]
    lines.append(f"- broadcast exchanges: {len(re.findall(r'^\(\d+\) BroadcastExchange', details, re.M))}")
    lines.append(f"- sort-merge joins: {len(re.findall(r'^\(\d+\) SortMergeJoin', details, re.M))}, "
                 f"broadcast hash joins: {len(re.findall(r'^\(\d+\) BroadcastHashJoin', details, re.M))}")
    lines.append(f"- stored inputs read (checkpoints): {len(re.findall(r'^\(\d+\) Scan ExistingRDD', details, re.M))}")
    lines.append(f"- Python stages: {len(re.findall(r'MapInPandas|ArrowEvalPython|BatchEvalPython', plan_text))}")
    for rs in sorted(set(re.findall(r"(ReadSchema: struct<[^>]*>)", plan_text))):
        lines.append(f"  - {rs}")
    for pf in sorted(set(re.findall(r"(PushedFilters: \[[^\]]*\])", plan_text))):
        lines.append(f"  - {pf}")
    return "\n".join(lines)


def main(argv: list[str]) -> None:
    full = "--full" in argv
    args = [a for a in argv[1:] if a != "--full"]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    names = args[1:] or list(HEADLINE)
    spark = build_session("local[8]", shuffle_partitions=16)
    plan = RecPlan(spark, sf_dir)
    for name in names:
        df = getattr(plan, name)
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        print(summarize(name, text))
        if full:
            print(text)
        print()


if __name__ == "__main__":
    main(sys.argv)
