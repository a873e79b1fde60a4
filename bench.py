"""Headline queries timed on one machine; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the timed runs after one
warm-up. Results go to Spark's noop sink, so every row is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from powerflow.catalogue import QUERIES
from powerflow.session import local_session

HEADLINES = [
    "gb_generation",
    "reconstruct_weighted",
    "process_gsp",
    "gb_forecast",
    "nl_generation",
    "be_generation",
    "de_generation",
    "ind_generation",
    "join_locations",
    "save_generation",
    "capacity_history",
    "save_forecast",
    "site_generation",
    "validate_capacity",
    "potential_generation",
    "trim_unsettled",
    "drop_existing",
    "latest_per_location",
    "collect_observations",
    "grid_completeness",
    "pivot_cube",
    "backfill_regional_cube",
]


def timed(spark, name: str, sf_dir: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    seconds = {}
    for name in HEADLINES:
        timed(spark, name, sf_dir)
        seconds[name] = round(statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 3)
    result = {
        "metric": "total of headline query medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
