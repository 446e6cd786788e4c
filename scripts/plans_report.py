"""Summarize the final adaptive physical plan of each registered query -> PLANS.md.

Usage: python scripts/plans_report.py [sf_dir] > PLANS.md
Each query is executed (collect) so that the adaptive plan is final; the
summary counts shuffles, join strategies, windows and aggregate kinds.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dailylake.catalog import REGISTRY  # noqa: E402
from dailylake.session import build_session  # noqa: E402

WRITES = {"src_bronze_json", "sink_bronze_roundtrip", "src_silver_parquet", "sink_silver_overwrite",
          "load_daily_replace_dt", "load_locations_full", "load_upsert_by_key", "load_upsert_partitioned", "backfill_range",
          "backfill_locations", "mart_incremental", "sink_bronze_rerun",
          "q_missing_partitions"}


def summarize(plan: str) -> dict:
    final = plan.split("== Initial Plan ==")[0]
    lines = final.splitlines()
    shuffle = re.compile(r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)")
    return {
        "shuffles": sum(1 for ln in lines if shuffle.search(ln) and "ReusedExchange" not in ln),
        "reused": sum(1 for ln in lines if "ReusedExchange" in ln),
        "broadcast_joins": final.count("BroadcastHashJoin"),
        "sort_merge_joins": final.count("SortMergeJoin"),
        "windows": final.count("Window ["),
        "hash_aggs": final.count("HashAggregate("),
        "sort_aggs": final.count("SortAggregate("),
        "codegen_stages": len(set(re.findall(r"\*\((\d+)\)", final))),
        "pushed": sorted({m for m in re.findall(r"PushedFilters: \[([^\]]*)", final) if m}),
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Final physical plans ({os.path.basename(sf_dir)}, AQE on, local[8])\n")
    print("Generated by `scripts/plans_report.py`. Write/round-trip queries are listed after the")
    print("read-side ones; their returned DataFrame is a scan of what they wrote.\n")
    print("| query | shuffles | reused exchanges | broadcast joins | sort-merge joins | windows | hash aggs | sort aggs | codegen stages |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    pushed = {}
    for name in sorted(REGISTRY, key=lambda n: (n in WRITES, n)):
        df = REGISTRY[name](spark, sf_dir)
        df.collect()
        s = summarize(df._jdf.queryExecution().executedPlan().toString())
        print(f"| {name} | {s['shuffles']} | {s['reused']} | {s['broadcast_joins']} | {s['sort_merge_joins']} | "
              f"{s['windows']} | {s['hash_aggs']} | {s['sort_aggs']} | {s['codegen_stages']} |")
        if s["pushed"]:
            pushed[name] = s["pushed"]
    print("\n## Filters pushed to Parquet scans\n")
    for name, p in pushed.items():
        print(f"- `{name}`: " + "; ".join(f"`{x[:160]}`" for x in p))


if __name__ == "__main__":
    main()
