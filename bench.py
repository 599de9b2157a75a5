"""Times the headline jobs and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. The four raw sources
are landed as files first; ``clean_join_count_write`` is then the same work the
published single-node timing covers: read, clean, join, count and write.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")

    from pyspark.sql import SparkSession

    from furrow.session import build_session

    SparkSession.builder.config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g")).config(
        "spark.ui.showConsoleProgress", "false"
    ).config("spark.ui.enabled", "false").master(f"local[{cpus}]").getOrCreate()
    spark = build_session("furrow-bench", f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")

    from furrow.plans import bound
    from furrow.plans.bound.tables import Tables
    from furrow.plans.curate import SOURCES, curate

    home = tempfile.mkdtemp(prefix="furrow-bench-")
    tables = Tables(spark, folder)
    for source in SOURCES:
        tables.raw(source).write.parquet(f"{home}/raw/{source}")
    queries = bound.queries()

    def clean_join_count_write() -> None:
        curated = curate({s: spark.read.parquet(f"{home}/raw/{s}") for s in SOURCES})
        curated.write.mode("overwrite").parquet(f"{home}/curated")
        spark.read.parquet(f"{home}/curated").count()

    def run(name: str) -> None:
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()

    headline = [
        "e4_accepted_yield", "e3_rejected_with_reasons_pesticides", "e9_overall_score", "j1_curated", "a4_mean_by_crop",
        "t1_top_observations", "a6_regions_above_average", "w1_rank_best_year", "w3_year_over_year_all", "a14_distribution",
        "w6_mean_z_by_area", "x4_iqr_outliers", "x6_welch_verdict", "j10_calendar_lag", "m2_features", "m4_baseline_metrics",
        "m17_roc_auc", "x9_drift_report", "g4_dense_ids",
    ]
    clean_join_count_write()  # the first run also pays for class loading
    times: dict[str, float] = {}
    for name, work in [("clean_join_count_write", clean_join_count_write), *[(n, lambda n=n: run(n)) for n in headline]]:
        start = time.perf_counter()
        work()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline jobs, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
