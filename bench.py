"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(default 1), BENCH_ONLY (comma list of query names). Each query is planned and run from scratch in
every run, over its whole tables, into a sink that discards the rows. One warm-up run comes first;
the figure is the median of the others.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lakeshift.session import local_session  # noqa: E402
from lakeshift.workload import QUERIES  # noqa: E402

HEADLINE = [
    "flagship_reconcile",
    "reconcile_partitions",
    "inventory_counts",
    "pf_union",
    "filtered_row_count",
    "content_summary",
    "copy_plan",
    "data_presence",
    "advance_status_copy",
    "advance_status_validate",
    "merge_upsert",
    "copy_gate",
    "finalize_copy",
    "report_performance",
    "group_control",
    "resolve_tokens",
    "fill_down_context",
    "policy_compile",
    "policy_sync_plan",
    "lineage_all",
    "scan_lines",
    "scan_code",
    "rewrite_findings",
    "apply_rewrites",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ["BENCH_ONLY"].split(",") if os.environ.get("BENCH_ONLY") else HEADLINE
    spark = local_session("bench")
    seconds: dict[str, float] = {}
    for name in names:
        taken = []
        for _ in range(1 + runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
