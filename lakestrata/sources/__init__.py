"""Readers. Each takes the session, a path or table name, and an explicit schema."""

from lakestrata.sources.delimited import (
    read_delimited,
    read_landed,
    read_landed_day,
    split_bad_rows,
)
from lakestrata.sources.documents import (
    column_names,
    document_fields,
    landed_fields,
    landed_schemas,
    read_document_arrays,
    read_document_lines,
    read_objects,
    split_bad_lines,
    with_fields,
)
from lakestrata.sources.tables import read_parquet, read_place, read_table

__all__ = [
    "column_names",
    "document_fields",
    "landed_fields",
    "landed_schemas",
    "read_delimited",
    "read_document_arrays",
    "read_document_lines",
    "read_landed",
    "read_landed_day",
    "read_objects",
    "read_parquet",
    "read_place",
    "read_table",
    "split_bad_lines",
    "split_bad_rows",
    "with_fields",
]
