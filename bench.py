"""Time the catalogue: one JSON line on standard output.

BENCH_SF_DIR names the tables, BENCH_CPUS the local threads and BENCH_QUERIES a
comma-separated choice of queries, or "all" (default: the headline queries below).
Each query is built and run in full against the noop sink, once to warm up and
BENCH_RUNS more times; the median of these counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from jobloom.plans import catalog  # noqa: E402
from jobloom.session import get_spark  # noqa: E402

HEADLINES = (
    "role_skill_top20", "skill_demand_rank", "role_stats", "job_hours_old", "cycle_report",
    "cycle_totals_by_day", "stage_raw_dedup", "clean_status", "normalize_naukri", "normalize_all",
    "explode_feed", "classify_skills", "unknown_terms", "role_overlap_scores", "find_role_cascade",
    "nearest_role_vector", "graph_job_nodes", "graph_skill_edges", "graph_salary_nodes", "graph_upsert",
    "mark_ingested", "duplicate_streak_cut", "page_novelty_stop", "hwm_increment", "run_metrics",
    "stream_cycle_counts", "stream_stage", "run_cycle_counts",
)


def run_once(spark, build, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    asked = os.environ.get("BENCH_QUERIES", "")
    chosen = list(catalog.queries()) if asked == "all" else [q for q in asked.split(",") if q] or HEADLINES
    spark = get_spark(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")},
    )
    times: dict[str, float] = {}
    for name, build in catalog.queries().items():
        if name not in chosen:
            continue
        try:
            run_once(spark, build, sf_dir)
            times[name] = round(statistics.median(run_once(spark, build, sf_dir) for _ in range(runs)), 3)
        except Exception as err:  # noqa: BLE001 - one broken query must not hide the others
            print(f"{name}: {str(err).splitlines()[0]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({
        "metric": "catalogue_total" if asked == "all" else "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
