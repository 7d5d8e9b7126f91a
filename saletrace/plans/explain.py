"""Print the physical plan of a catalogue query.

    python -m saletrace.plans.explain tiered_match [--at-scale] [--sf DIR] [--full]

``--at-scale`` turns off size-based broadcasts so the plan shows the
shuffle layout that inputs too big to broadcast get (constant lookups keep
their broadcast hint).  Without ``--full`` only the operator outline is
printed (one line per node, no attribute lists).
"""

from __future__ import annotations

import re
import sys


def outline(plan: str) -> str:
    keep = []
    for line in plan.splitlines():
        if not line.strip() or line.lstrip().startswith("(") or line.startswith("=="):
            continue
        line = re.sub(r"\s*\[[^\]]*\].*$", "", line)       # attribute lists
        line = re.sub(r"\s*\(\d+\)$", "", line)              # node ids
        keep.append(line.rstrip())
    return "\n".join(keep)


def main(argv: list[str]) -> None:
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from saletrace.plans.catalog import QUERIES
    from saletrace.session import build_session

    name = argv[0]
    sf = argv[argv.index("--sf") + 1] if "--sf" in argv else "/root/testdata/sf0.01"
    extra = {"spark.sql.adaptive.enabled": "false"}
    if "--at-scale" in argv:
        extra.update({"spark.sql.autoBroadcastJoinThreshold": "-1",
                      "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    spark = build_session("local[4]", extra=extra)
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    print(plan if "--full" in argv else outline(plan))


if __name__ == "__main__":
    main(sys.argv[1:])
