"""Summarise the physical plan of every catalog query (after execution, so
AQE's final plan is shown) into a Markdown table: scans, shuffles, broadcast
exchanges, joins, sorts and windows.  Usage:

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starbuild.plans import catalog  # noqa: E402
from starbuild.session import local_session  # noqa: E402


def summarise(plan: str) -> dict[str, int | str]:
    lines = plan.splitlines()
    final = lines
    # AdaptiveSparkPlan prints the final plan first, then "+- == Initial Plan ==".
    for i, ln in enumerate(lines):
        if "== Initial Plan ==" in ln:
            final = lines[:i]
            break
    text = "\n".join(final)
    shuffles = [ln for ln in final if re.search(r"Exchange (hashpartitioning|rangepartitioning|"
                                                r"SinglePartition|RoundRobin)", ln)
                and "ReusedExchange" not in ln]
    return {
        "scans": len(re.findall(r"FileScan|Scan ExistingRDD|Scan OneRowRelation", text)),
        "shuffles": len(shuffles),
        "single_partition": sum("SinglePartition" in ln for ln in shuffles),
        "reused": text.count("ReusedExchange"),
        "broadcasts": text.count("BroadcastExchange"),
        "bhj": text.count("BroadcastHashJoin"),
        "smj": text.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", text)),
    }


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print("# Physical plans per query key\n")
    print(f"Generated by `tools/plan_report.py` on `{os.path.basename(sf)}` (local[*], AQE on),")
    print("from the final adaptive plan of each query after it ran.  `single_partition`")
    print("counts shuffles into one partition; each is over an already-aggregated")
    print("result (one row per query, per column, or per input partition).\n")
    cols = ["scans", "shuffles", "single_partition", "reused", "broadcasts", "bhj", "smj",
            "windows"]
    print("| key | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for key, fn in catalog.QUERIES.items():
        df = fn(spark, sf)
        qe = df._jdf.queryExecution()
        qe.toRdd().count()              # run this plan itself so AQE finalises it
        s = summarise(qe.executedPlan().toString())
        print(f"| `{key}` | " + " | ".join(str(s[c]) for c in cols) + " |")


if __name__ == "__main__":
    main(sys.argv)
