"""Time the headline queries.  Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from worklode.queries import callables  # noqa: E402
from worklode.session import build_session  # noqa: E402

HEADLINE = [
    "hiring_trends", "company_hiring", "location_trends", "salary_trends", "skill_demand", "skill_demand_by_sector",
    "sector_overview", "run_health", "classify_changes", "apply_changes", "change_log", "apply_history", "fact_lifecycle",
    "resolve_foreign_keys", "change_with_version", "dense_keys", "previous_row_change", "uniqueness_flag", "row_flags",
    "rules_referential", "rules_salary", "quarantine_summaries", "retention_plan", "assign_sectors", "extract_skills", "match_roles",
    "canonicalize_companies", "identity_map", "skill_co_occurrence", "skill_graph", "table_digests", "bundle_round_trip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "worklode-bench", f"local[{cpus}]", spark__sql__shuffle__partitions=str(max(int(cpus), 1)), spark__ui__enabled="false",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"), spark__driver__bindAddress="127.0.0.1", spark__driver__host="127.0.0.1",
        spark__sql__execution__arrow__pyspark__enabled="true",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = callables()
    spark.read.parquet(f"{sf_dir}/orders.parquet").count()  # start-up is not part of any query
    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
    print(json.dumps({
        "metric": "worklode_headline_total", "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
