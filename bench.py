"""Headline queries at one scale; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (local cores), BENCH_RUNS
(timed runs per query, the median counts), BENCH_QUERIES (comma list, or
``all``).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

HEADLINE = (
    "uv_pv_by_type",
    "landing_bounce_kpi",
    "show_click_kpi",
    "conflicting_ids",
    "domain_uv_pv",
    "load_show_log",
    "load_page_views",
    "user_agent_report",
    "stitch_show_click_bid",
    "resolve_tags_with_fallback",
    "recent_per_group",
    "pair_counts",
    "scored_site_neighbours",
    "group_recommender",
    "confidence_recommender",
    "session_summary",
    "connected_components",
    "identity_map",
    "history_merge_changes",
    "daily_channel_merge",
    "stream_log_lines",
)


def main() -> int:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

    from clickloom.queries import QUERIES
    from clickloom.session import build_session

    spark = build_session(
        f"local[{cpus}]", "clickloom-bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="clickloom-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = list(QUERIES) if wanted == "all" else [n for n in wanted.split(",") if n] or list(HEADLINE)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)$", folder)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(scale.group(1)) if scale else folder,
    }))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
