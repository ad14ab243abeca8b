"""Wall time of the headline queries, warm, as one JSON line after every query; the last line is the whole result.

Settings: ``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores), ``BENCH_REPEATS`` (timed runs
per query, the median counts) and ``BENCH_QUERIES`` (comma-separated names).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from pyspark.sql import Observation
from pyspark.sql import functions as F

from cohortwise import catalogue
from cohortwise.session import local_session

HEADLINES = (
    "c5_clean_rows",
    "c5_cleaning_audit",
    "e3_describe_numeric",
    "e4_category_frequencies",
    "u7_point_biserial",
    "u8_binned_rates",
    "u9_category_rates",
    "l1_design_matrix",
    "l9_margins_adjusted",
    "l11_association",
    "m8_nearest_references",
    "m9_greedy_matching",
    "m15_balance_table",
    "m19_propensity_matching",
    "p2_stratified_split",
    "p7_evaluation",
    "p9_group_recall",
    "p11_permutation_importance",
    "p16_local_impacts",
    "p18_what_if_levels",
    "x6_reliability_curve",
    "x8_threshold_scan",
    "p5_boosted_trees",
    "x1_cross_validation",
    "x4_out_of_fold",
)


# Each fits models in full; timed once, after a run over the smallest tables for code generation.
MODEL_QUERIES = ("p5_boosted_trees", "x1_cross_validation", "x4_out_of_fold")
WARM_UP_FOLDER = "/root/testdata/sf0.001"


def timed(spark, folder: str, name: str) -> dict:
    """Seconds, rows out and Spark jobs of one run; nothing is reused from an earlier one."""
    spark.catalog.clearCache()
    catalogue.prediction.forget()
    group = f"{name}-{time.time_ns()}"
    spark.sparkContext.setJobGroup(group, name)
    start = time.perf_counter()
    df = catalogue.QUERIES[name](spark, folder)
    seen = Observation("rows")
    # A no-op sink computes every column without moving rows to the driver.
    df.observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    seconds = time.perf_counter() - start
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    return {"seconds": seconds, "rows_out": seen.get["n"], "jobs": jobs}


def report(seconds: dict, details: dict, folder: str, rows_in: int, done: bool) -> None:
    """One JSON line with everything measured so far; the last one is complete."""
    found = re.search(r"sf([0-9.]+)", folder)
    line = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(found.group(1).rstrip(".")) if found else None,
        "rows_in": rows_in,
        "details": details,
        "complete": done,
    }
    print(json.dumps(line), flush=True)


def main() -> int:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINES
    spark = local_session(cpus, cpus)
    rows_in = spark.read.parquet(f"{folder}/lineitem.parquet").count()
    seconds, details = {}, {}
    for name in names:
        fits = name in MODEL_QUERIES
        timed(spark, WARM_UP_FOLDER if fits and os.path.isdir(WARM_UP_FOLDER) else folder, name)
        runs = [timed(spark, folder, name) for _ in range(1 if fits else repeats)]
        seconds[name] = round(statistics.median(r["seconds"] for r in runs), 3)
        details[name] = {"rows_out": runs[-1]["rows_out"], "jobs": runs[-1]["jobs"]}
        print(f"{name}: {seconds[name]}s {details[name]}", file=sys.stderr, flush=True)
        # a run that is ended early leaves what it has measured
        report(seconds, details, folder, rows_in, name == names[-1])
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
