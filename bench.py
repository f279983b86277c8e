"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores. Every query is
run to the last row and column into Spark's no-op sink; the better of two runs counts, so that
class loading and code generation are not measured.
"""

from __future__ import annotations

import json
import os
import time

from casemill.registry import all_queries
from casemill.session import local_session

HEADLINE = (
    "e1_consolidation",
    "e2a_provisional_report",
    "e2b_task_report",
    "e3_models",
    "e4_comparison",
    "e5_id_coverage",
    "e5_volumetry",
    "j2_j3_j4_resolve_ids",
    "j11_service_remap_over_lines",
    "s13_j13_identity_overrides",
    "s7_employee_master",
    "x1_normalize_text",
    "d1_parse_date",
    "d5_elapsed_minutes",
    "s1_comma_export",
    "k1_report_table",
    "a1_daily_counts",
    "u2_aligned_concat",
    "m3_row_numbers",
    "m4_training_matrix",
)


def seconds(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    queries = all_queries()
    times = {
        name: round(min(seconds(queries[name], spark, folder) for _ in range(2)), 3)
        for name in HEADLINE
    }
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
