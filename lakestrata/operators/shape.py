"""Column choice, names, values and row filters. All narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.functions import canonical, to_int


def _require(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")


def drop_fields(df: DataFrame, names: Iterable[str], strict: bool = False) -> DataFrame:
    """Without these columns. ``strict`` makes a name that is not there an error."""
    names = list(names)
    if strict:
        _require(df, names)
    return df.drop(*names)


def rename_fields(df: DataFrame, names: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Rename old -> new, keeping column order."""
    if strict:
        _require(df, names)
    return df.withColumnsRenamed(dict(names))


def project_key(df: DataFrame, key: str) -> DataFrame:
    """The key column alone, one row per input row."""
    return df.select(key)


def keep_equal(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """Rows whose column equals ``value``; all rows when ``value`` is None."""
    return df if value is None else df.filter(F.col(column) == F.lit(value))


def canonicalise(df: DataFrame, column: str, spellings: Mapping[str, str]) -> DataFrame:
    """Replace listed spellings in place. For a handful of literals."""
    return df.withColumn(column, canonical(column, spellings))


def canonicalise_from(df: DataFrame, column: str, spellings: DataFrame) -> DataFrame:
    """The same with the spellings in a table ``(spelling, canonical)``, one row per spelling.

    The join carries no hint: Spark broadcasts the table if its size allows.
    """
    known = spellings.select(F.col("spelling").alias(column), F.col("canonical").alias("_new"))
    joined = df.join(known, column, "left")
    return joined.select(
        *[F.coalesce("_new", column).alias(c) if c == column else F.col(c) for c in df.columns]
    )


def to_int_columns(df: DataFrame, *columns: str) -> DataFrame:
    """Cast text columns to int in place; text that is no number becomes null."""
    return df.withColumns({c: to_int(c) for c in columns})
