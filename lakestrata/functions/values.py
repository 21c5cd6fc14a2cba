from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_int(column: Column | str) -> Column:
    """Text to int: null where it is no number, the fraction cut off.

    Same values as a cast with ANSI mode off, in either mode. Only digits reach
    the cast: for other text it would raise and catch an error in every row.
    """
    whole = F.regexp_extract(column, r"^\s*([+-]?[0-9]+)(\.[0-9]*)?\s*$", 1)
    return F.nullif(whole, F.lit("")).try_cast("int")


def canonical(column: Column | str, spellings: Mapping[str, str]) -> Column:
    """Replace the listed spellings; other values and null stay."""
    column = F.col(column) if isinstance(column, str) else column
    if not spellings:
        return column
    (first, new), *rest = spellings.items()
    cases = F.when(column == F.lit(first), F.lit(new))
    for old, new in rest:
        cases = cases.when(column == F.lit(old), F.lit(new))
    return cases.otherwise(column)
