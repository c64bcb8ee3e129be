"""Print the physical plan tree and scan schemas of selected queries (markdown).

Usage: python -m tests.plan_report /root/testdata/sf0.1 key ... > PLANS.md
The plan is the one Spark executed (AQE final plan after a noop run).
"""

from __future__ import annotations

import re
import sys


def main(argv):
    sf = argv[1]
    keys = argv[2:]
    sys.path.insert(0, ".")
    from staylens.plans.queries import REGISTRY
    from staylens.session import local_session

    spark = local_session(8, 16)
    print(f"# Physical plans at {sf}\n")
    print("Generated by `python -m tests.plan_report`: the final adaptive (AQE) plans of the analytic")
    print("queries over the written marts, local[8]. At this size AQE turns most joins into broadcasts")
    print("after measuring the reduced sides; at scale the same plans keep sort-merge joins. Scans list")
    print("only the columns each query reads.\n")
    for k in keys:
        df = REGISTRY[k](spark, sf)
        df.collect()  # runs through df's own QueryExecution, so AQE's final plan is shown
        plan = df._jdf.queryExecution().executedPlan()
        text = plan.toString()
        tree = [ln for ln in text.split("\n") if ln.strip()]
        tree = [re.sub(r"\[[^\]]{120,}\]", "[...]", ln)[:220] for ln in tree]
        print(f"## {k}\n")
        doc = (REGISTRY[k].__doc__ or "").strip().split("\n")[0]
        if doc:
            print(doc + "\n")
        print("```")
        print("\n".join(tree))
        print("```\n")


if __name__ == "__main__":
    main(sys.argv)
