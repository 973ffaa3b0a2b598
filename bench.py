"""Benchmark the headline reports.

Runs every end-to-end report of the four workloads (plus ingest) at
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints one JSON line: {"metric", "value" (total seconds), "unit",
"queries" {name: seconds}, "sf", "rows" {name: rows}}.

Each timing covers building the plan and collecting the (small) result; a
warm-up on the smallest tables runs first so the timings exclude JVM start.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from citypulse.catalog import QUERIES  # noqa: E402
from citypulse.session import local_session  # noqa: E402

HEADLINE = [
    "typed_ingest_count",
    "top_months_df", "top_months_sql",
    "day_parts_df", "day_parts_sql", "day_parts_rows",
    "income_extremes_sql", "income_extremes_broadcast", "income_extremes_merge",
    "income_extremes_merge_small", "income_extremes_shuffle_hash", "income_extremes_replicate_nl",
    "own_dist_by_year", "own_dist_by_division",
    "own_dist_broadcast", "own_dist_merge", "own_dist_shuffle_hash", "own_dist_replicate_nl",
    "nearest_by_year", "nearest_by_division",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores=cpus, shuffle_partitions=cpus * 2, app="citypulse-bench")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="citypulse-bench-ckpt-"))
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        QUERIES["top_months_df"](spark, warm).collect()

    timings, rows = {}, {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        if name == "typed_ingest_count":
            n = QUERIES["row_count"](spark, sf_dir).collect()[0][0]
        else:
            n = len(QUERIES[name](spark, sf_dir).collect())
        timings[name] = round(time.perf_counter() - t0, 3)
        rows[name] = n
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds_headline_reports",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        "rows": rows,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
