"""One value per row out of lists. All narrow: no shuffle, unless products are cut.

A row whose list is null or empty gives no row, unless ``keep_empty``. Un-nesting
several lists of one record gives the product of their lengths.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _explode(keep_empty: bool):
    return F.explode_outer if keep_empty else F.explode


def explode_text(
    df: DataFrame, *columns: str, sep: str = ",", keep_empty: bool = False
) -> DataFrame:
    """Split text lists at ``sep`` (literal text) and un-nest each in place.

    Items are not trimmed, and empty text is a list of one empty item.
    """
    explode = _explode(keep_empty)
    for column in columns:
        df = df.withColumn(column, explode(F.split(column, rf"\Q{sep}\E")))
    return df


def explode_list(df: DataFrame, column: str, item: str, keep_empty: bool = False) -> DataFrame:
    """Replace an array column by a column ``item`` with one element per row."""
    return df.select("*", _explode(keep_empty)(column).alias(item)).drop(column)


def explode_structs(
    df: DataFrame, column: str, fields: Mapping[str, str], keep_empty: bool = False
) -> DataFrame:
    """Replace an array of structs by one column per entry of ``fields`` (new -> field).

    Fields that are not asked for are pruned before the explode.
    """
    items = df.select("*", _explode(keep_empty)(column).alias("_item"))
    values = {new: F.col("_item").getField(field) for new, field in fields.items()}
    return items.withColumns(values).drop(column, "_item")


def cut_products(df: DataFrame, columns: Sequence[str], block_rows: int) -> DataFrame:
    """Records cut so that the product of their lists has at most ``block_rows`` items.

    The product is known from the sizes, before anything is un-nested. The first lists are
    cut, as far as it takes, into runs of items that follow each other; the runs' products
    together are the record's. A record below the bound is a single piece.
    """
    sizes = {c: F.greatest(F.coalesce(F.size(c), F.lit(0)), F.lit(1)).cast("double") for c in columns}
    # As doubles: a product of sizes may not fit a long.
    rests, rest = {}, F.lit(1.0)
    for column in reversed(columns):
        rests[column], rest = rest, rest * sizes[column]
    lengths = {
        f"_run{i}": F.greatest(F.floor(F.lit(float(block_rows)) / rests[c]), F.lit(1))
        for i, c in enumerate(columns)
    }
    pieces = df.withColumns(lengths)
    for i, column in enumerate(columns):
        size = F.greatest(F.coalesce(F.size(column), F.lit(0)), F.lit(1))
        run = F.least(F.col(f"_run{i}"), size).cast("int")
        starts = F.explode(F.sequence(F.lit(1), size, run))
        pieces = pieces.withColumn("_start", starts).withColumn(
            column, F.slice(column, F.col("_start"), run)
        )
    return pieces.drop("_start", *lengths)


def unnest_lists(
    df: DataFrame,
    lists: Mapping[str, Mapping[str, str]],
    keep_empty: bool = False,
    block_rows: int | None = None,
) -> DataFrame:
    """``explode_structs`` for several arrays of a record, one after the other.

    All narrow, so the rows of a record come from one task. For records whose product is
    too much for a task, ``block_rows`` cuts them into pieces that give at most as many rows, and
    deals the pieces to all tasks before they are un-nested: one shuffle of the documents.
    """
    if block_rows is not None:
        n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = cut_products(df, list(lists), block_rows).repartition(n)
    for column, fields in lists.items():
        df = explode_structs(df, column, fields, keep_empty)
    return df
