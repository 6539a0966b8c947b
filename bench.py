"""Benchmark: seconds per headline query, as one JSON line.

Each query is run once to warm up and then measured, its whole result written
to a sink that drops it. BENCH_SF_DIR and BENCH_CPUS choose data and cores;
BENCH_QUERIES (comma-separated) chooses other queries.
"""

from __future__ import annotations

import json
import os
import time

from prflow.queries import QUERIES
from prflow.session import local_session

HEADLINES = (
    "page_accept",
    "page_stitch",
    "page_progress",
    "project_pull_request",
    "project_check_suite",
    "edit_delete_overlay",
    "any_delete_flag",
    "insert_if_absent",
    "set_fields",
    "actor_by_id",
    "actor_by_login",
    "actors_of_pull_requests",
    "unsaved_commits_all",
    "incomplete_parents_embedded",
    "actual_totals_override",
    "reconcile_step",
    "reconcile_recursive",
    "load_pull_requests",
    "load_edits",
    "load_commit_ids",
    "load_commits",
    "load_check_suites",
    "load_participants",
    "load_reactions",
    "load_commit_authors",
    "load_commit_pull_request_ids",
)


def measure(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINES
    spark = local_session("prflow-bench", cores)
    seconds = {}
    for name in names:
        measure(spark, name, folder)
        seconds[name] = round(measure(spark, name, folder), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cores": cores,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
