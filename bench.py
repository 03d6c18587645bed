"""Time headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from hireflow.plans.build import Run, Warehouse
from hireflow.session import local_session, scratch_path
from hireflow.sources.schemas import RAW, SOURCES
from hireflow.verification import canonical, check_queries, model_queries, source_queries  # noqa: F401
from hireflow.verification.registry import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    "b02_parse_mixed_date",
    "w01_dedupe_latest",
    "w02_event_sequence",
    "w02_event_sequence_spread",
    "m01_stg_jobs",
    "m02_stg_candidates",
    "m04_stg_applications",
    "m05_stg_workflow_events",
    "m06_int_workflow_events_enriched",
    "m08_dim_candidate",
    "m09_fct_applications",
    "m10_fct_workflow_events",
    "m11_agg_time_to_hire",
    "m12_dq_hired_before_applied",
    "q02_unique",
    "q10_suite_summary",
    "s01_open_jobs",
    "s02_eager_candidate_count",
    "s03_eager_candidates",
    "s04_top_departments",
    "p02_column_profile",
    "p04_date_pattern_profile",
    "p08_anomaly_probe",
    "i01_upsert_by_key",
    "l03_incremental_aggregate",
    "l08_scd2_history",
]


def run(spark, name: str) -> float:
    """Seconds from building a query to its last row; rows are produced and thrown away."""
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def run_builds(spark) -> dict[str, float]:
    """All layers: days that touch one application of a hundred each, against a rebuild.

    Raw tables lie in folders by day, as loads leave them. The first small day and the first rebuild
    warm up; the best of the others counts.
    """
    root = scratch_path(spark, "bench-raw")
    for source in SOURCES:
        rows = canonical.raw_with_late_hires(spark, SF_DIR, source)
        rows.write.partitionBy("_ingestion_date").parquet(f"{root}/{source}")

    def raw(source):
        return spark.read.schema(RAW[source]).parquet(f"{root}/{source}")

    def build(warehouse, day, **kw) -> float:
        start = time.perf_counter()
        warehouse.build(Run(day, canonical.NOW, **kw))
        return time.perf_counter() - start

    warehouse, rebuilds = Warehouse(spark, scratch_path(spark, "bench"), raw, 8), []
    for _ in range(2):
        rebuilds.append(build(warehouse, canonical.DAYS[-1], full_refresh=True))
    days = [build(warehouse, day) for day in canonical.LATE_DAYS]
    return {"build_small_day": round(min(days[1:]), 3), "build_rebuild": round(rebuilds[-1], 3)}


def main() -> None:
    names = sys.argv[1:] or HEADLINE
    spark = local_session(CPUS, "bench")
    # First run warms up code generation; the best of the others counts.
    times = {}
    for name in names:
        if name == "builds":
            continue
        run(spark, name)
        times[name] = round(min(run(spark, name) for _ in range(RUNS)), 3)
    total = round(sum(times.values()), 3)  # of the headline queries alone
    if not sys.argv[1:] or "builds" in sys.argv[1:]:
        times |= run_builds(spark)
    print(
        json.dumps(
            {
                "metric": "total_headline_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
