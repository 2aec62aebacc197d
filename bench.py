"""Time the headline queries and print one JSON line.

``queries`` holds the library's form. ``as_written`` holds the same results from
the plain SQL that scans the facts once per condition or drug class, on the same
Spark session, as there is no published number to compare with.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fixture_views import BASE_TABLES  # noqa: E402
from oracle_catalog import ORACLE  # noqa: E402
from query_catalog import CATALOG  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "covariates",
    "study_history",
    "study_exposure",
    "study_outcomes",
    "exposure_by_class",
    "outcome_labels",
    "history_guard_last_branch",
    "index_first_by_date",
    "global_row_number_of_events",
)
COMPARED = ("covariates", "study_history", "study_exposure", "study_outcomes", "exposure_by_class")


def session() -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("cohortloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.doubleQuotedIdentifiers", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="cohortloom-bench-"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def best_time(build) -> float:
    """Best of several runs, from building the plan to consuming every row."""
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return round(min(times), 3)


def main() -> None:
    spark = session()
    for table in BASE_TABLES:
        spark.read.parquet(f"{FOLDER}/{table}.parquet").createOrReplaceTempView(table)
    for name in HEADLINE:  # warm up the JVM
        CATALOG[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    timed = {n: best_time(lambda n=n: CATALOG[n](spark, FOLDER)) for n in HEADLINE}
    written = {n: best_time(lambda n=n: spark.sql(ORACLE[n])) for n in COMPARED}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "as_written": written,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
