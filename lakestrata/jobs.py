"""The jobs of the lake: ``lake_jobs.py <job> --source .. --target ..`` for spark-submit."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from lakestrata import plans, schemas
from lakestrata.session import job_folder, tune
from lakestrata.sinks import compact_documents
from lakestrata.sources import read_parquet

RENAMES = {"movies": schemas.MOVIE_RENAMES, "series": schemas.SERIES_RENAMES}


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *flags: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for flag in ("--source", "--target", *flags):
            sub.add_argument(flag, required=True)
        return sub

    land = job("land")
    land.add_argument("--run-date", type=date.fromisoformat, required=True)
    land.add_argument("--multi-line", action="store_true", help="values with line breaks")
    land.add_argument("--quarantine", help="folder for lines that are no rows")
    enrich = job("enrich", "--lookups")
    enrich.add_argument("--run-date", type=date.fromisoformat, required=True)
    enrich.add_argument("--landed-on", type=date.fromisoformat)
    enrich.add_argument("--artist")
    enrich.add_argument("--chunk-size", type=int, default=schemas.CHUNK_SIZE)
    enrich.add_argument("--order-by", help="number the chunks in this order, as JSON arrays")
    enrich.add_argument("--multi-line", action="store_true")
    local = job("trusted-local", "--table")
    local.add_argument("--multi-line", action="store_true")
    local.add_argument("--kind", choices=RENAMES, required=True)
    local.add_argument("--artist")
    local.add_argument("--quarantine", help="folder for lines that are no rows")
    local.add_argument("--buckets", type=int, help="buckets of the table by title")
    documents = job("trusted-documents", "--table")
    documents.add_argument("--arrays", action="store_true", help="files of one JSON array each")
    documents.add_argument("--quarantine", help="folder for lines that are no documents")
    documents.add_argument("--block-rows", type=int, help="most rows of a piece of a document")
    compact = job("compact-documents")
    compact.add_argument("--arrays", action="store_true")
    job("refined-series")
    movies = job("refined-movies", "--batches")
    movies.add_argument(
        "--documents", action="store_true", help="the batches are landed documents, not tables"
    )
    movies.add_argument("--origin-per-batch", action="store_true")
    movies.add_argument("--keep-unmatched", action="store_true")
    return parser.parse_args(argv)


def run(spark: SparkSession, argv: list[str] | None = None) -> None:
    """Runs one job. What it has staged is gone when it ends or fails."""
    arguments = _arguments(argv)
    with job_folder(tune(spark)):
        _run(spark, arguments)


def _run(spark: SparkSession, a: argparse.Namespace) -> None:
    match a.job:
        case "land":
            plans.run_landing(spark, a.source, a.target, a.run_date, a.multi_line, a.quarantine)
        case "compact-documents":
            compact_documents(spark, a.source, a.target, arrays=a.arrays)
        case "enrich":
            plans.run_enrichment(
                spark,
                a.source,
                read_parquet(spark, a.lookups),
                a.target,
                a.artist,
                a.run_date,
                a.landed_on,
                a.chunk_size,
                a.order_by,
                a.multi_line,
            )
        case "trusted-local":
            renames = RENAMES[a.kind]
            plans.run_local(
                spark,
                a.source,
                a.target,
                renames,
                a.artist,
                a.table,
                multi_line=a.multi_line,
                quarantine=a.quarantine,
                buckets=a.buckets,
            )
        case "trusted-documents":
            plans.run_documents(
                spark,
                a.source,
                a.target,
                a.table,
                a.arrays,
                quarantine=a.quarantine,
                block_rows=a.block_rows,
            )
        case "refined-series":
            plans.run_series(spark, a.source, a.target)
        case "refined-movies":
            plans.run_unified_movies(
                spark,
                a.source,
                a.batches.split(","),
                a.target,
                a.origin_per_batch,
                a.keep_unmatched,
                documents=a.documents,
            )


def main(argv: list[str] | None = None) -> None:
    """Checks the arguments, then starts a session whose catalog outlives the job."""
    _arguments(argv)
    run(SparkSession.builder.enableHiveSupport().getOrCreate(), argv)
