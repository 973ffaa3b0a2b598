"""Print a compact digest of the physical plan of registered queries.

usage: python tools/plan_digest.py [sf_dir] [name ...]

For each query: the operators of the executed (AQE final) plan, one per
line with its depth, without expression detail - exchanges, joins,
aggregates, windows, scans with pushed filters and read schema.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from citypulse.catalog import QUERIES  # noqa: E402
from citypulse.session import local_session  # noqa: E402

KEEP = re.compile(r"(Exchange|Join|CartesianProduct|HashAggregate|Window|Sort\b|TakeOrdered|"
                  r"Union|Scan|Generate|Expand|Subquery|Limit|AQEShuffleRead)")


def digest(plan: str) -> list[str]:
    plan = plan.split("== Initial Plan ==")[0]
    out = []
    for line in plan.splitlines():
        m = KEEP.search(line)
        if not m:
            continue
        indent = len(line) - len(line.lstrip(" :+-"))
        text = line.strip(" :+-*()0123456789")
        text = re.sub(r"#\d+L?", "", text)
        if "Scan" in text:
            pushed = re.search(r"PushedFilters: \[([^\]]*)\]", line)
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", line)
            loc = re.search(r"\[file:[^\]]*/([^/\]]+)\]", line)
            text = (f"Scan {loc.group(1) if loc else ''} pushed=[{pushed.group(1)[:80] if pushed else ''}] "
                    f"{schema.group(1)[:100] if schema else ''}")
        else:
            text = text[:110]
        out.append(" " * (indent // 3) + text)
    return out


def _show_checkpointed_plans():
    """Iterative operators (the nearest-station search) do their work when a
    level is checkpointed; print the plan of each checkpointed DataFrame."""
    from pyspark.sql.classic.dataframe import DataFrame

    original = DataFrame.checkpoint

    def checkpoint(self, eager=True):
        out = original(self, eager)
        print("### checkpointed step")
        print("```")
        print("\n".join(digest(self._jdf.queryExecution().executedPlan().toString())))
        print("```")
        return out

    DataFrame.checkpoint = checkpoint


def main():
    args = sys.argv[1:]
    if "--steps" in args:
        args.remove("--steps")
        _show_checkpointed_plans()
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    names = [a for a in args if not os.path.isdir(a)] or sorted(QUERIES)
    spark = local_session()
    for name in names:
        df = QUERIES[name](spark, sf_dir)
        df.collect()
        print(f"## {name}")
        print("```")
        print("\n".join(digest(df._jdf.queryExecution().executedPlan().toString())))
        print("```")


if __name__ == "__main__":
    main()
