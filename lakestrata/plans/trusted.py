"""Trusted zone: harmonised names and values, one value per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakestrata.operators import (
    canonicalise,
    drop_fields,
    explode_text,
    keep_equal,
    rename_fields,
    unnest_lists,
)
from lakestrata.schemas import (
    COUNTRY_SPELLINGS,
    DOCUMENT,
    DOCUMENT_LISTS,
    DOCUMENT_UNUSED,
    KEEP_VERSIONS,
    LOCAL_UNUSED,
    TRUSTED_DATABASE,
    file_schema,
)
from lakestrata.session import replaced_folder, tune_landed_reads
from lakestrata.sinks import save_table
from lakestrata.sources import (
    column_names,
    document_fields,
    landed_fields,
    read_delimited,
    read_document_arrays,
    read_document_lines,
    split_bad_lines,
    split_bad_rows,
    with_fields,
)


def trusted_local_rows(
    raw: DataFrame, renames: Mapping[str, str], artist: str | None, keep_empty: bool = False
) -> DataFrame:
    """A local file's rows of one artist (all, if None), by genre and profession."""
    return (
        raw.transform(drop_fields, LOCAL_UNUSED, strict=True)
        .transform(rename_fields, renames, strict=True)
        .transform(keep_equal, "artist_name", artist)
        .transform(explode_text, "genre", "profession", keep_empty=keep_empty)
    )


def trusted_document_rows(
    documents: DataFrame,
    spellings: Mapping[str, str] = COUNTRY_SPELLINGS,
    keep_empty: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """A document's rows: genre x company x country x language.

    A document with one of the lists null or empty gives no row, unless
    ``keep_empty``. ``block_rows`` is that of ``unnest_lists``.
    """
    return (
        documents.transform(drop_fields, DOCUMENT_UNUSED)
        .transform(unnest_lists, DOCUMENT_LISTS, keep_empty, block_rows)
        .transform(canonicalise, "production_country_name", spellings)
    )


def run_local(
    spark: SparkSession,
    source: str,
    target: str,
    renames: Mapping[str, str],
    artist: str | None,
    table: str,
    database: str = TRUSTED_DATABASE,
    multi_line: bool = False,
    quarantine: str | None = None,
    buckets: int | None = None,
) -> str:
    """One local file; ``quarantine`` is that of ``run_landing``, and the table has that many
    ``buckets`` by title."""
    contract = file_schema([*renames, *LOCAL_UNUSED])
    if quarantine is None:
        raw = read_delimited(spark, source, contract=contract, multi_line=multi_line)
    else:
        raw, bad = split_bad_rows(spark, source, contract, multi_line=multi_line)
        with replaced_folder(spark, quarantine) as folder:
            bad.write.parquet(folder)
    rows = trusted_local_rows(raw, renames, artist)
    by_title = ("imdb_id", buckets) if buckets else None
    return save_table(
        rows, database, table, target, keep_versions=KEEP_VERSIONS, buckets=by_title
    )


def run_documents(
    spark: SparkSession,
    source: str,
    target: str,
    table: str,
    arrays: bool = False,
    database: str = TRUSTED_DATABASE,
    schema: T.StructType | None = None,
    quarantine: str | None = None,
    block_rows: int | None = None,
) -> str:
    """One batch of documents: one object per line, as they land, or files of JSON ``arrays``.

    All fields are kept. Those that ``DOCUMENT`` does not declare have the types that the
    landing has kept. Where it has kept none they are JSON text, and the documents are read once
    more to find their names, unless a ``schema`` says what to read. A field whose name differs
    from a column's only in case, or is that of a column made from a list, gets a number behind it.
    A record that is no document ends the job; with ``quarantine`` such lines are written
    to that folder, with the name of their file, and the others go on.
    """
    if quarantine and arrays:
        raise ValueError("quarantine takes lines; a file that is no array is always an error")
    tune_landed_reads(spark)
    if schema is None:
        fields = landed_fields(spark, source)
        if fields is None:
            fields = document_fields(spark, source, arrays)
        schema = with_fields(DOCUMENT, fields)
    made = [column for columns in DOCUMENT_LISTS.values() for column in columns]
    names = column_names(schema, made)
    if quarantine:
        rows, bad = split_bad_lines(spark, source, schema, names)
        with replaced_folder(spark, quarantine) as folder:
            bad.write.parquet(folder)
    else:
        read = read_document_arrays if arrays else read_document_lines
        rows = read(spark, source, schema, names=names)
    rows = trusted_document_rows(rows, block_rows=block_rows)
    return save_table(rows, database, table, target, keep_versions=KEEP_VERSIONS)
