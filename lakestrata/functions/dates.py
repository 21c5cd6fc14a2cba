from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the partition columns, with the pattern that fills each.
DATE_PARTS = {"year": "yyyy", "month": "MM", "day": "dd"}


def date_parts(when: Column | date) -> dict[str, Column]:
    """Zero-padded ``year``, ``month`` and ``day`` text of a column or a run date."""
    moment = F.lit(when) if isinstance(when, date) else when
    return {name: F.date_format(moment, pattern) for name, pattern in DATE_PARTS.items()}


def path_date_parts(path: Column | str = "_metadata.file_path") -> dict[str, Column]:
    """The same parts from a path with plain ``/2023/11/06/`` directories.

    Spark finds partitions only in ``year=2023`` style directories.
    """
    pattern = r"/(\d{4})/(\d{2})/(\d{2})/[^/]*$"
    return {
        name: F.regexp_extract(path, pattern, group)
        for group, name in enumerate(DATE_PARTS, start=1)
    }
