"""Seconds per query over the tables in BENCH_SF_DIR; prints one JSON line.

Each query is planned, run and drained into a sink that throws rows away. It runs
BENCH_RUNS times and the fastest run counts, so that the start of the JVM is not measured.
"""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tablewarden.plans.registry import QUERIES  # noqa: E402
from tablewarden.session import build_session  # noqa: E402

HEADLINE = [
    "adult_filter",
    "filter_counts",
    "employee_transform",
    "mapping_project",
    "kpi_avg_by_department",
    "quality_checks",
    "quality_metrics",
    "pk_violations",
    "column_stats",
    "reconcile",
    "upsert_entities",
    "resolve_refs",
    "validate_entities",
    "search_contains",
    "search_tag_page",
    "catalog_summary",
    "metadata_audit",
    "business_metadata_latest",
    "schema_diff",
    "column_lineage",
    "build_edges",
    "lineage_down",
    "lineage_up",
    "impact",
    "propagate_tags",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    spark.stop()
    report = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }
    print(json.dumps(report), flush=True)


if __name__ == "__main__":
    main()
