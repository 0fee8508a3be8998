"""Time the headline queries at ``$BENCH_SF_DIR`` and print one JSON line.

Each query is computed in full into Spark's ``noop`` sink. One untimed run of the first
query starts the JVM's compiler, as the published numbers come from a running process.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans.catalog import CATALOG
from tidemark.plans.inputs import Inputs
from tidemark.session import build_session

# Query -> table whose rows it processes, for records per second.
HEADLINE = {
    "telemetry_windows": "events",
    "windows_with_lateness": "events",
    "window_changelog": "events",
    "run_summary": "events",
    "watermark_before": "events",
    "supplier_windows": "lineitem",
    "top_anomaly_per_key": "events",
    "top20_rows": "events",
    "max_per_key": "events",
    "percentiles": "events",
    "keep_latest": "events",
    "sink_outcome_counts": "events",
    "dead_letter": "events",
    "lake_upsert": "events",
    "serving_upsert": "events",
    "native_windows_final": "events",
    "late_windows_exact": "events",
    "late_window_processor": "events",
}


def run(inputs: Inputs, name: str) -> float:
    began = time.perf_counter()
    CATALOG[name](inputs).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8)
    names = sys.argv[1:] or list(HEADLINE)
    rows = {t: Inputs(spark, sf_dir).table(t).count() for t in set(HEADLINE.values())}
    run(Inputs(spark, sf_dir), "windows_with_lateness")
    # Fresh inputs per query: each pays for its own lateness pass.
    seconds = {name: run(Inputs(spark, sf_dir), name) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {n: round(s, 3) for n, s in seconds.items()},
                "records_per_sec": {
                    n: round(rows[HEADLINE[n]] / s) for n, s in seconds.items() if n in HEADLINE
                },
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
