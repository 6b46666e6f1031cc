"""Write PLANS.md: the physical operators of the headline queries (no
expressions), so exchanges, joins, windows, Python nodes, codegen stages and
scan pushdown can be reviewed at a glance.  Usage:
``python tools/plan_summary.py [sf_dir]``."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from logsift.plans.catalog import load_all  # noqa: E402
from logsift.session import local_session  # noqa: E402

KEEP = re.compile(r"(Exchange|Join|Window|FileScan|Scan ExistingRDD|Aggregate|TakeOrdered|Python|Pandas|Arrow|"
                  r"Generate|Sort |InMemory|Union|LocalTableScan)")


def summarise(plan: str) -> list[str]:
    plan = plan.split("== Initial Plan ==")[0]  # adaptive plans: keep the final one
    out = []
    for line in plan.splitlines():
        if not KEEP.search(line):
            continue
        depth = (len(line) - len(line.lstrip(" :+-"))) // 3
        node = line.strip(" :+-")
        stage = re.match(r"^\*\((\d+)\)\s*", node)
        if stage:
            node = node[stage.end():]
        name = re.split(r"[\[(]", node, maxsplit=1)[0].strip()
        if name.startswith("FileScan"):
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", node)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", node)
            name += f"  ReadSchema={schema.group(1) if schema else '?'}  PushedFilters={pushed.group(1) if pushed else '[]'}"
        elif name == "Exchange":
            kind = re.search(r"(hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", node)
            name += f" {kind.group(1) if kind else ''}"
        if stage:
            name = f"*({stage.group(1)}) {name}"
        out.append("  " * min(depth, 12) + name)
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 16)
    reg = load_all()
    lines = ["# Physical plans of the headline queries", "",
             f"Generated by `tools/plan_summary.py` at `{sf}` (operators only, expressions elided;",
             "plans of eager steps such as checkpoints are not shown, only the final query;",
             "`*(n)` marks whole-stage-codegen stage n).", ""]
    for key in HEADLINE:
        df = reg[key].build(spark, sf)
        df.collect()  # run it, so the adaptive plan is final (codegen stages, runtime joins)
        plan = df._jdf.queryExecution().executedPlan().toString()
        codegen = len(set(re.findall(r"\*\((\d+)\)", plan)))
        lines += [f"## {key}", "", f"whole-stage-codegen stages: {codegen}", "", "```"]
        lines += summarise(plan) or ["(local relation)"]
        lines += ["```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
