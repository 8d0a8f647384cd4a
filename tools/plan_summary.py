"""Summarize the physical plan of every registered product as a markdown table.

usage: python tools/plan_summary.py [sf_dir] > docs/PLANS.md

Counts, in the plan Spark chooses before running (AQE may still coalesce or
convert at runtime), with dimensions broadcast and with broadcasts off: hash shuffles, range shuffles (global sorts), broadcast
exchanges, join strategies, and aggregates; and lists the columns each scan
reads.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakemart.session import build_session  # noqa: E402


def summarize(plan: str) -> dict:
    scans = re.findall(r"FileScan \w+ ([\w.]*)\[([^\]]*)\].*?Location: \w+\(\d+ paths?\)\[([^\]]*)\]", plan)
    reads = []
    for ident, cols, loc in scans:
        table = re.sub(r"^run[0-9a-f]+_", "", ident.removeprefix("spark_catalog.")) or "/".join(loc.rstrip("/").split("/")[-2:])
        names = [c.split("#")[0] for c in cols.split(",") if c]
        reads.append(f"{table}({', '.join(names)})")
    return {
        "hash shuffles": plan.count("Exchange hashpartitioning"),
        "single-partition": plan.count("Exchange SinglePartition"),
        "sort shuffles": plan.count("Exchange rangepartitioning"),
        "broadcasts": plan.count("BroadcastExchange"),
        "joins": ", ".join(sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)"
                                                 r"[^\n]*?(LeftOuter|Inner|LeftAnti|LeftSemi)", plan))
                                  and {f"{a} {b}" for a, b in re.findall(
                                      r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)[^\n]*?"
                                      r"(LeftOuter|Inner|LeftAnti|LeftSemi)", plan)})) or "-",
        "partial aggs": len(re.findall(r"(HashAggregate|SortAggregate)\([^\n]*partial_", plan)),
        "reads": "; ".join(dict.fromkeys(reads)) or "-",
    }


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    from lakemart.plans.registry import QUERIES

    print(f"# Physical plans\n\nGenerated by `tools/plan_summary.py {sf_dir}` (Spark {spark.version}, "
          "plans before AQE's runtime changes). Reports read the written gold tables, layer products "
          "the written layer below; see `lakemart/plans/registry.py`.")
    cols = ["hash shuffles", "sort shuffles", "single-partition", "broadcasts", "joins", "partial aggs", "reads"]
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for title, threshold in (("Dimensions under the broadcast threshold", usual), ("No broadcasts", "-1")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        print(f"\n## {title}\n\n| product | " + " | ".join(cols) + " |")
        print("| --- | " + " | ".join("---" for _ in cols) + " |")
        for name, fn in QUERIES.items():
            s = summarize(fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString())
            print(f"| `{name}` | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
