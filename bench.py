"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR   folder of the given tables   (default /root/testdata/sf0.1)
BENCH_CPUS     local task slots             (default all processors)

Each query is run in full into a sink that discards rows. ``refined_tables`` starts
from stored trusted tables, as the refined job does. ``bench.py --stepwise`` times
the step-by-step form on those tables as well; its joins multiply rows, so use it
with a small BENCH_SF_DIR.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from lakestrata import plans, schemas
from lakestrata.session import stage, tune
from workload.inputs import SPELLINGS, document_batches, local_file
from workload.registry import QUERIES
from workload.stepwise import unified_movies_stepwise

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS") or str(os.cpu_count())

HEADLINE = [
    "trusted_local_movies",
    "trusted_documents",
    "refined_series",
    "unified_movies",
    "unified_movies_origin_per_batch",
    "unified_movies_keep_unmatched",
    "unified_movies_from_documents",
    "collect_companies",
    "attach_and_explode",
    "values_by_batch",
    "distinct_rows",
    "enrich",
    "schema_groups",
    "chunk_within",
    "encode_chunks",
    "land_chunks",
    "land_by_date",
    "landed_lookups",
    "catalogued_lake",
]


def session() -> SparkSession:
    folder = tempfile.mkdtemp(prefix="lakestrata-bench-")
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lakestrata-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.checkpoint.dir", f"{folder}/checkpoints")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(name: str, build) -> float:
    start = time.perf_counter()
    run(build())
    seconds = round(time.perf_counter() - start, 3)
    print(name, seconds, file=sys.stderr, flush=True)
    return seconds


def main() -> None:
    spark = session()
    run(QUERIES["trusted_local_movies"](spark, SF_DIR))  # starts the JVM's compilers
    times = {n: timed(n, lambda n=n: QUERIES[n](spark, SF_DIR)) for n in HEADLINE}

    local = stage(
        plans.trusted_local_rows(local_file(spark, SF_DIR), schemas.MOVIE_RENAMES, None)
    )
    batches = [
        stage(plans.trusted_document_rows(b, SPELLINGS)) for b in document_batches(spark, SF_DIR)
    ]
    times["refined_tables"] = timed(
        "refined_tables", lambda: plans.unified_movies_rows(local, batches, origin_per_batch=True)
    )
    baseline = {}
    if "--stepwise" in sys.argv:
        baseline = {"stepwise": timed("stepwise", lambda: unified_movies_stepwise(local, batches))}
    result = {
        "metric": "lake_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "baseline": baseline,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": int(CPUS),
    }
    sys.stdout.write(json.dumps(result) + "\n")
    spark.stop()


if __name__ == "__main__":
    main()
