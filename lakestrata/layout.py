"""Where the raw zone keeps a day, tables their versions, and how delimited files are written."""

from __future__ import annotations

import uuid
from datetime import UTC, date, datetime

# A header row; a quote inside a quoted field is doubled.
# Blanks at the ends of a value belong to it.
DELIMITED = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# An unquoted empty field is null and a quoted one is empty text, on both sides.
# Spark takes both for null while its null marker is empty text; no field holds NUL.
DELIMITED_READ = {**DELIMITED, "nullValue": "\0", "emptyValue": ""}


def day_path(path: str, run_date: date) -> str:
    """Folder of one day, named so that Spark finds the partitions."""
    return f"{path}/year={run_date:%Y}/month={run_date:%m}/day={run_date:%d}"


VERSION = "version="

# Beside landed documents: their fields and types, by set of fields. Readers skip the name.
SCHEMAS = "_schemas"
# Beside compacted documents: where the records of each landed file are.
INDEX = "_index"
KEPT = (
    "schema_id string, schema_key string, fields array<struct<name: string, type: string>>,"
    " schema string"
)


def new_version() -> str:
    """A folder name for a new version of a table's data; later ones sort behind earlier ones."""
    return f"{VERSION}{datetime.now(UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
