"""Raw zone: land files by run date; land the documents of the keys in a file."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakestrata.layout import day_path
from lakestrata.operators import enrich_counted, found, keep_equal, project_key, with_schema_key
from lakestrata.schemas import CHUNK_SIZE, check_contract, file_schema
from lakestrata.session import replaced_folder, tune
from lakestrata.sinks import land_by_date, land_chunks
from lakestrata.sources import read_delimited, read_landed_day, split_bad_rows


# Columns of a local file that give the keys to look up.
KEY, ARTIST = "id", "nomeArtista"


# What a looked-up key has to bring; the key has the type of the local file's.
LOOKUPS = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("payload", T.StringType()),
    ]
)


def run_landing(
    spark: SparkSession,
    source: str,
    target: str,
    run_date: date,
    multi_line: bool = False,
    quarantine: str | None = None,
) -> None:
    """Copy a delimited dataset, whatever its columns, into the folder of the run date.

    A line with more or fewer fields than the header ends the job; with ``quarantine`` such
    lines are written to that folder, with the name of their file, and all others land.
    """
    if quarantine is None:
        rows = read_delimited(spark, source, multi_line=multi_line)
    else:
        rows, bad = split_bad_rows(spark, source, multi_line=multi_line)
        with replaced_folder(spark, quarantine) as folder:
            bad.write.parquet(folder)
    land_by_date(rows, target, run_date, multi_line=multi_line)


def enriched_rows(
    local: DataFrame,
    lookups: DataFrame,
    artist: str | None,
    key: str = KEY,
    artist_column: str = ARTIST,
) -> DataFrame:
    """The documents found for the artist's keys, with their set of fields and ``copies``.

    ``lookups`` has the key, ``status`` and ``payload``. Failed lookups are
    filtered before the join, so they are not shuffled. A key listed n times has
    its document landed n times: that number is ``copies``.
    """
    keys = local.transform(keep_equal, artist_column, artist).transform(project_key, key)
    return enrich_counted(keys, found(lookups), key).transform(with_schema_key)


def run_enrichment(
    spark: SparkSession,
    local_path: str,
    lookups: DataFrame,
    target: str,
    artist: str | None,
    run_date: date,
    landed_on: date | None = None,
    size: int = CHUNK_SIZE,
    order_by: str | None = None,
    multi_line: bool = False,
) -> str:
    """Land the documents of the keys of a landed file; return the folder.

    Reads the day ``landed_on`` (the run date unless given) and writes the run
    date. Which kind of entity the keys are is a matter of the ``lookups`` given.
    """
    tune(spark)
    local = read_landed_day(
        spark,
        local_path,
        landed_on or run_date,
        file_schema([KEY, ARTIST]),
        multi_line=multi_line,
    )
    path = day_path(target, run_date)
    rows = enriched_rows(local, check_contract(lookups, LOOKUPS), artist)
    land_chunks(rows, path, size=size, order_by=order_by, copies="copies")
    return path
