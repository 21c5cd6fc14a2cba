"""Joins, distinct values and unions of tables and batches.

No join here has a broadcast hint. A side that is small at run time is broadcast
by adaptive execution on its measured size; otherwise both sides are shuffled on
the key and a hot key is cut into several tasks (see ``session.ADAPTIVE``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.grouping import number_within
from lakestrata.session import stage

# Most hashes of repeated rows that are kept apart: so many are broadcast.
_FEW_HASHES = 200_000


def attach(left: DataFrame, right: DataFrame, key: str, *columns: str) -> DataFrame:
    """All rows and columns of ``left`` with ``columns`` of ``right``, by left join on ``key``.

    Without a match the new columns are null; a null key matches nothing.
    """
    return left.join(right.select(key, *columns), key, "left").select(*left.columns, *columns)


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """All rows of all batches, duplicates kept, columns matched by name."""
    return reduce(DataFrame.unionByName, batches)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Each row once. Copies are merged before the shuffle, which is on all columns."""
    return df.distinct()


def distinct_of_few(df: DataFrame) -> DataFrame:
    """``distinct_rows`` of rows that have few copies, if any: only hashes of all rows are shuffled.

    Equal rows have equal hashes. So a row whose hash occurs once has no copy and stays as it
    is, and the others, copies or not, are compared in full. Where they are many, all rows
    are. ``df`` is read twice, three times with copies, and has to give the same rows each time.
    """
    marked = df.withColumn("_hash", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    counts = marked.groupBy("_hash").agg(F.count("*").alias("n"))
    repeated = stage(counts.filter("n > 1").select("_hash"), "repeated")
    n = repeated.count()
    if n > _FEW_HASHES:
        return distinct_rows(df)
    if n == 0:
        return df
    alone, others = (marked.join(repeated, "_hash", kind) for kind in ("left_anti", "left_semi"))
    return alone.drop("_hash").unionByName(others.drop("_hash").transform(distinct_rows))


def collect_distinct(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Per key, the sorted list of its distinct non-null values; empty if it has none.

    Duplicates go first, by key and value together, so a key with many rows is
    spread and only its distinct values meet. A key's list must fit into a row:
    where it might not, use ``known_pairs``, which has the same content as rows.
    """
    return (
        df.select(key, value)
        .distinct()
        .groupBy(key)
        .agg(F.array_sort(F.collect_list(value)).alias(name))
    )


def collect_segments(
    df: DataFrame, key: str, value: str, name: str, size: int = 1000
) -> DataFrame:
    """The lists of ``collect_distinct`` in segments of at most ``size`` values.

    Segments are numbered from 1 in column ``segment``, in the order of the values, so all
    segments of a key one after the other are its list. A list may be longer than a row can be,
    and a key may have most of all values: they are numbered by ranges, and a segment is all that
    meets in one place. A key without values has one empty segment.
    """
    pairs = df.select(key, value).dropna(subset=[value]).distinct()
    numbered = number_within(pairs, key, value, "_position")
    segments = (
        numbered.withColumn("segment", F.expr(f"(_position - 1) div {int(size)} + 1"))
        .groupBy(key, "segment")
        .agg(F.array_sort(F.collect_list(value)).alias(name))
    )
    empty = (
        df.groupBy(key)
        .agg(F.count(value).alias("_n"))
        .filter("_n = 0")
        .select(
            key,
            F.lit(1).cast("bigint").alias("segment"),
            F.array().cast(segments.schema[name].dataType).alias(name),
        )
    )
    return segments.unionByName(empty)


def known_pairs(df: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct ``(key, value)`` rows without nulls."""
    return df.select(key, value).dropna().distinct()


def values_by_batch(
    batches: Sequence[DataFrame], key: str, value: str, names: Sequence[str]
) -> DataFrame:
    """Per key, the combinations of the values it has in each batch, one column per batch.

    A key with k1, k2, .. distinct values (null is one) gives k1 * k2 * .. rows;
    a batch without the key gives null. All batches are read once and meet in one
    aggregate by key, whose sets are merged before the shuffle; a key's distinct values
    of a batch have to fit into a row, as their combinations are rows of the result.
    """
    numbered = [b.select(F.lit(i).alias("_batch"), key, value) for i, b in enumerate(batches)]
    return values_of_batches(union_batches(numbered), "_batch", key, value, names)


def values_of_batches(
    df: DataFrame, batch: str, key: str, value: str, names: Sequence[str]
) -> DataFrame:
    """``values_by_batch`` for rows that carry the number of their batch, from 0."""
    sets = [
        F.collect_set(F.when(F.col(batch) == i, F.struct(F.col(value).alias("v")))).alias(name)
        for i, name in enumerate(names)
    ]
    out = df.filter(F.col(key).isNotNull()).groupBy(key).agg(*sets)
    for name in names:
        rest = [c for c in out.columns if c != name]
        out = out.select(*rest, F.explode_outer(name).alias(name))
    return out.select(key, *[F.col(name)["v"].alias(name) for name in names])
