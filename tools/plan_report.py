"""Summarise the physical plan of every registered batch query into PLANS.md.

usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "scans": r"FileScan parquet",
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "single-partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "reused": r"ReusedExchange",
    "windows": r"\bWindow \[",
    "group limits": r"WindowGroupLimit",
    "explodes": r"Generate ",
    "python": r"FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython|MapInPandas",
}


def main():
    from pulselens.plans.catalog import Q
    from pulselens.session import get_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    spark.conf.set("spark.sql.adaptive.enabled", "false")       # static plan, before AQE re-planning
    print("# Physical plan summary of the registered batch queries\n")
    print(f"Generated by `tools/plan_report.py` on `{sf}` with AQE off (the static plan; AQE may later "
          "coalesce partitions, switch joins to broadcast and split skewed partitions). Counts are plan "
          "nodes; `pushed` lists the filters Parquet receives.\n")
    print("| query | " + " | ".join(PATTERNS) + " | pushed filters |")
    print("|---|" + "---|" * (len(PATTERNS) + 1))
    for k in sorted(Q):
        if k.startswith("sink"):
            continue
        p = Q[k](spark, sf)._jdf.queryExecution().executedPlan().toString()
        counts = [str(len(re.findall(v, p))) for v in PATTERNS.values()]
        pushed = sorted(set(re.findall(r"PushedFilters: \[(.*?)\], ReadSchema", p)))
        pushed = "; ".join(x for x in pushed if x) or "-"
        print(f"| {k} | " + " | ".join(counts) + f" | {pushed.replace('|', '/')} |")


if __name__ == "__main__":
    main()
