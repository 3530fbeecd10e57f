"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline query as its own plan on ``local[$BENCH_CPUS]`` and
forces its whole result (a ``noop`` write, so every column is computed).
Before timing, one query runs untimed on sf0.001 so that JVM start-up and
code generation warm-up are not charged to the first timed query; the
output says so. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corate.config import apply_conf  # noqa: E402
from corate.plans.registry import QUERIES  # noqa: E402

# runs from the parquet tables with nothing cached between queries.
HEADLINE = [
    "sim_cosine",
    "mae_cosine",
    "mae_jaccard",
    "mae_knn_by_k",
    "pair_overlap_stats",
]
# The reference's three programs as composite reports, timed the same way
# and reported separately (not part of "value").
PROGRAMS = [
    "report_similarity",
    "report_knn",
    "report_recommend",
]
WARMUP_SF_DIR = "/root/testdata/sf0.001"
WARMUP_QUERY = "mae_comparison"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = apply_conf(SparkSession.builder.master(f"local[{cpus}]").appName("corate-bench"),
                         shuffle_partitions=2 * cpus)
    spark = builder.config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "16g")) \
        .getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    warm = False
    if os.path.isdir(WARMUP_SF_DIR):
        QUERIES[WARMUP_QUERY](spark, WARMUP_SF_DIR).write.format("noop").mode("overwrite").save()
        warm = True

    def timed(names: list[str]) -> dict[str, float]:
        out = {}
        for name in names:
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            out[name] = round(time.perf_counter() - start, 3)
        return out

    times = timed(HEADLINE)
    programs = timed(PROGRAMS)

    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "probe_steps_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "programs": programs,
        "sf": sf,
        "cpus": cpus,
        "warmup": f"{WARMUP_QUERY} on sf0.001, untimed" if warm else "none",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
