"""Time the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from panelkit.session import local_session  # noqa: E402
from workload import load  # noqa: E402

HEADLINE = [
    "flatten_tree", "compile_results", "compare_runs_summary", "compare_runs_diffs", "report_latest_wins", "gap_spans",
    "gap_causes", "find_gaps_plan", "candidate_map", "waterfall_resolution", "filled_panel", "build_panel_merge",
    "coverage_db", "availability_breakdown", "no_later_report", "group_year_stats", "line_item_quantiles", "trimmed_stats",
    "tail_top5", "contribution_shares", "zero_streaks", "page_ranking", "line_ranking", "context_text",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("panelkit-bench", cores=cpus, shuffle_partitions=int(cpus))
    queries, _ = load()
    spark.read.parquet(f"{sf}/nation.parquet").count()      # session start is not part of a query
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        queries[name](spark, sf).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf}))


if __name__ == "__main__":
    main()
