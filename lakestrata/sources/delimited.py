from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions import path_date_parts
from lakestrata.functions.dates import DATE_PARTS
from lakestrata.layout import DELIMITED_READ, day_path
from lakestrata.schemas import check_contract


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    contract: T.StructType | None = None,
    sep: str = "|",
    mode: str = "FAILFAST",
    dated_directories: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Delimited text with a header row.

    With a ``schema`` the header has to match it, column by column. Without one
    the columns are those of the header, all text; ``contract`` names columns
    that must be there, in any position. Either way no value is inspected.

    ``dated_directories`` walks plain ``yyyy/mm/dd`` directories below ``path``
    and adds the date as ``year``, ``month`` and ``day``. ``multi_line`` reads values with
    line breaks; files are then not split.
    """
    reader = spark.read.options(**DELIMITED_READ, sep=sep, mode=mode, enforceSchema="false")
    reader = reader.option("multiLine", str(multi_line).lower())
    if schema is not None:
        reader = reader.schema(schema)
    if dated_directories:
        rows = reader.option("recursiveFileLookup", "true").csv(path)
        rows = rows.withColumns(path_date_parts())
    else:
        rows = reader.csv(path)
    return rows if contract is None else check_contract(rows, contract)


def split_bad_rows(
    spark: SparkSession,
    path: str | list[str],
    contract: T.StructType | None = None,
    sep: str = "|",
    multi_line: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The rows of ``read_delimited`` and, as ``path, value``, the raw lines that are none.

    A line is no row of the file if it has more or fewer fields than the header. The columns are
    those of the header, all text; a file with another header is still an error. A reader that
    takes some columns only sees the same bad lines.
    """
    options = {**DELIMITED_READ, "sep": sep, "multiLine": str(multi_line).lower()}
    names = spark.read.options(**options).csv(path).columns
    marker = "_bad"
    while marker.lower() in {n.lower() for n in names}:
        marker += "_"
    marked = T.StructType([T.StructField(n, T.StringType()) for n in [*names, marker]])
    rows = (
        spark.read.schema(marked)
        .options(**options, mode="PERMISSIVE", enforceSchema="false")
        .options(columnNameOfCorruptRecord=marker, columnPruning="false")
        .csv(path)
    )
    # Spark refuses to read the marker alone, so no part of another column is added to it.
    raw = F.concat(marker, F.substring(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), 1, 0))
    bad = rows.filter(raw.isNotNull()).select(
        F.col("_metadata.file_path").alias("path"), raw.alias("value")
    )
    good = rows.filter(raw.isNull()).drop(marker)
    return (good if contract is None else check_contract(good, contract)), bad


def read_landed_day(
    spark: SparkSession,
    path: str,
    run_date: date,
    contract: T.StructType | None = None,
    sep: str = "|",
    multi_line: bool = False,
) -> DataFrame:
    """One day of a dataset written by ``sinks.land_by_date``; no other day is looked at."""
    day = day_path(path, run_date)
    return read_delimited(spark, day, contract=contract, sep=sep, multi_line=multi_line)


def read_landed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = "|",
    multi_line: bool = False,
) -> DataFrame:
    """All days, with their ``year``, ``month`` and ``day`` as text.

    A filter on these columns is a partition filter: other days are not read.
    """
    dated = T.StructType(
        schema.fields + [T.StructField(name, T.StringType()) for name in DATE_PARTS]
    )
    reader = spark.read.schema(dated).options(**DELIMITED_READ, sep=sep, mode="FAILFAST")
    return reader.option("multiLine", str(multi_line).lower()).csv(path)
