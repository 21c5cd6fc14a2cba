"""Writers. Each can be run again with the same input and leaves the same data."""

from lakestrata.sinks.catalog import save_table
from lakestrata.sinks.compaction import compact_documents, fetch_records
from lakestrata.sinks.landing import land_by_date, land_chunks

__all__ = ["compact_documents", "fetch_records", "land_by_date", "land_chunks", "save_table"]
