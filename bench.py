"""Time the headline queries; prints one JSON line.

Every query is planned and run to the end (noop sink), after one warm-up scan.
"""

from __future__ import annotations

import json
import os
import sys
import time

import catalog
from gridloom.session import build_session

HEADLINE = [
    "coverage_audit", "unique_rows", "batch_split", "lhs_strata", "experiment_table",
    "mesh_row_decisions", "setup_decisions", "stack_boundaries", "post_decisions", "matched_times",
    "pair_manifest", "stage_counts", "run_report", "active_cases", "solver_log", "log_convergence",
    "region_priority", "validity_priority", "nearest_values", "linear_values", "near_walls",
    "signed_distances", "normalized_values", "padded_channels", "sample_tensors", "contract_violations",
    "transformed_samples", "batch_files", "live_stage_progress",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    chosen = sys.argv[1:] or HEADLINE
    registry = catalog.load()
    catalog.table(spark, sf_dir, "lineitem").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in chosen:
        start = time.time()
        registry[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}
        )
    )


if __name__ == "__main__":
    main()
