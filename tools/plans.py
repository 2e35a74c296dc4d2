"""Write the physical plan tree of every registered query to PLANS.md.

Usage: python tools/plans.py [sf_dir]
Queries that write tables while they are defined (tables, batch, events,
refresh, order items) are planned after those writes, as a client sees them.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from salesmart.plans.queries import REGISTRY  # noqa: E402
from salesmart.operators.partitions import explain_text  # noqa: E402
from salesmart.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=16)
    head = ["# Physical plans", "",
            f"`python tools/plans.py {sf_dir}` — the operator tree of each registered query "
            "(`explain(\"formatted\")`, before adaptive re-planning). Broadcasts here are chosen "
            "by Catalyst from file statistics (below `autoBroadcastJoinThreshold`) unless the "
            "query checks a size bound first; at larger sizes the same plans use shuffle joins.", "",
            "| query | shuffles | broadcasts | sort-merge joins | windows | top-k |",
            "| --- | --- | --- | --- | --- | --- |"]
    out = []
    for name, fn in REGISTRY.items():
        text = explain_text(fn(spark, sf_dir))
        tree = text.split("\n\n")[0].replace("== Physical Plan ==\n", "")
        scans, current = [], None
        for line in text.splitlines():
            if line.startswith("(") and "Scan" in line:
                current = line.strip()
            elif current and line.startswith(("PushedFilters", "ReadSchema", "PartitionFilters")):
                scans.append(f"{current} {line.strip()}")
        out += [f"## {name}", "", "```", tree.rstrip(), *scans, "```", ""]
        shuffles = len(re.findall(r"(^|[-:] )Exchange \(", tree, flags=re.M))
        counts = [shuffles] + [tree.count(k) for k in ("BroadcastExchange", "SortMergeJoin", "Window (",
                                                         "TakeOrderedAndProject")]
        head.append(f"| `{name}` | " + " | ".join(str(c) for c in counts) + " |")
    out = head + [""] + out
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
