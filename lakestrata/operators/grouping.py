"""Documents grouped by their set of keys, and groups cut into bounded chunks.

Most documents share one set of keys, so a group can hold nearly all rows. No
step here brings a group into one task: groups are range-partitioned, and only
chunks, which have a fixed maximum size, are collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.functions import schema_key
from lakestrata.schemas import CHUNK_SIZE
from lakestrata.session import stage

# Longest number sequence built in one row when a range is written out.
_RANGE_BLOCK = 10_000
# Files of chunks that one task writes, about.
TASK_FILES = 64
# The same where one task would write all files.
_FEW_FILES = 12
# Bytes of documents that one task writes at most, about.
_TASK_BYTES = 128 << 20
# Most ranges that chunks in order are dealt to; their bounds are part of the plan.
_RANGES = 256


def with_schema_key(
    df: DataFrame, payload: str = "payload", name: str = "schema_key"
) -> DataFrame:
    """Add the fingerprint that documents with the same top-level keys share."""
    return df.withColumn(name, schema_key(payload))


def schema_groups(df: DataFrame, name: str = "schema_key") -> DataFrame:
    """Documents per fingerprint, counted before the shuffle."""
    return df.groupBy(name).agg(F.count("*").alias("documents"))


def _place(
    df: DataFrame,
    group: str,
    order_by: str | Sequence[str],
    weight: Column,
    tasks: int | None = None,
) -> DataFrame:
    """Order the rows in groups across tasks; add ``_task``, ``_place`` and, as
    ``_before``, the weight of the group's rows in earlier tasks; ``_first`` is the
    group's first place in the task.

    The ordered rows are written once, because both the rows and the sums per
    task are taken from them: they must agree, also after the loss of an executor.
    The sums (one row per group and task) are written too. Spark then knows their
    size when it plans the join: if small they are broadcast, and the rows are
    not shuffled again. ``tasks`` is the number of ranges, one by size unless given.
    """
    keys = [group, *([order_by] if isinstance(order_by, str) else order_by)]
    rows = stage(
        (df.repartitionByRange(tasks, *keys) if tasks else df.repartitionByRange(*keys))
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id()),
        "ordered",
    )
    # The upper bits of the place are the task, the lower 33 the row in it.
    rows = rows.withColumn("_task", F.shiftright("_place", 33))
    per_task = rows.groupBy(group, "_task").agg(
        F.min("_place").alias("_first"), F.sum(weight).alias("_weight")
    )
    earlier = Window.partitionBy(group).orderBy("_task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = per_task.select(
        F.col(group).alias("_group"),
        F.col("_task").alias("_of_task"),
        "_first",
        F.coalesce(F.sum("_weight").over(earlier), F.lit(0)).alias("_before"),
    )
    return rows.join(
        stage(starts, "starts"),
        F.col(group).eqNullSafe(F.col("_group")) & (F.col("_task") == F.col("_of_task")),
    )


def number_within(
    df: DataFrame, group: str, order_by: str | Sequence[str], name: str = "position"
) -> DataFrame:
    """Number the rows of each group from 1, in the given order.

    The number is that of ``row_number`` over a window by group, without the
    window's one task per group. ``order_by`` should identify a row in its group:
    rows that tie are numbered in any order and stay in one task. For many equal
    rows count them and use ``chunk_copies``.
    """
    rows = _place(df, group, order_by, F.lit(1))
    position = F.col("_place") - F.col("_first") + F.col("_before") + 1
    return rows.select(*df.columns, position.alias(name))


def chunk_within(
    df: DataFrame, group: str, order_by: str | Sequence[str], size: int = CHUNK_SIZE
) -> DataFrame:
    """Add ``position`` and ``chunk``: blocks of ``size`` rows in each group, from 1."""
    return number_within(df, group, order_by).withColumn("chunk", _chunk("position", size))


def running_sum(
    df: DataFrame, group: str, order_by: str | Sequence[str], weight: str, name: str
) -> DataFrame:
    """Add the sum of ``weight`` over the rows of the group up to and with this one.

    It is that of a window by group, without the window's one task per group. ``order_by``
    should identify a row in its group, as for ``number_within``.
    """
    rows = _place(df, group, order_by, F.col(weight))
    so_far = Window.partitionBy(group, "_task").orderBy("_place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    total = F.col("_before") + F.sum(weight).over(so_far)
    return rows.withColumn(name, total).select(*df.columns, name)


def chunk_copies(
    df: DataFrame,
    group: str,
    order_by: str | Sequence[str],
    copies: str = "copies",
    size: int = CHUNK_SIZE,
) -> DataFrame:
    """``chunk_within`` for rows that each stand for ``copies`` equal ones.

    One row per row and chunk it reaches into, with its first ``position`` there
    and the ``copies`` that fall into the chunk.
    """
    ends = running_sum(df, group, order_by, copies, "_end").withColumn(
        "_start", F.col("_end") - F.col(copies) + 1
    )
    chunks = _each(ends, "chunk", _chunk("_start", size), _chunk("_end", size))
    chunks = chunks.withColumn(
        "position", F.greatest("_start", (F.col("chunk") - 1) * F.lit(size) + 1)
    ).withColumn(
        copies, F.least("_end", F.col("chunk") * F.lit(size)) - F.col("position") + 1
    )
    return chunks.select(*df.columns, "position", "chunk")


def split_copies(df: DataFrame, copies: str = "copies", size: int = CHUNK_SIZE) -> DataFrame:
    """Rows that each stand for at most ``size`` copies, in the same total number."""
    blocks = _each(df, "_block", F.lit(1).cast("bigint"), _chunk(copies, size))
    left = F.col(copies) - (F.col("_block") - 1) * F.lit(size)
    return blocks.withColumn(copies, F.least(left, F.lit(size))).drop("_block")


def repeat_copies(df: DataFrame, copies: str = "copies") -> DataFrame:
    """Each row as many times as it says. Meant for what ``split_copies`` has bounded."""
    return df.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy", copies)


def deal_by_files(
    df: DataFrame,
    group: str,
    size: int = CHUNK_SIZE,
    copies: str | None = None,
    payload: str | None = None,
) -> DataFrame:
    """Deal stored rows to tasks that each write about ``TASK_FILES`` files of ``size`` rows.

    A group goes to as many tasks as its files ask for, or the bytes of its ``payload`` if they ask
    for more, by chance within the group; small groups share one. If all files are a single task's, it writes
    fewer, so that there are several. Only the sums of each group are collected. The rows are read twice.
    """
    n = F.col(copies).cast("long") if copies else F.lit(1).cast("long")
    length = F.coalesce(F.octet_length(payload), F.lit(0)) if payload else F.lit(0)
    sums = df.groupBy(group).agg(F.sum(n).alias("n"), F.sum(n * length).alias("bytes"))
    held = sums.orderBy(group).collect()
    tasks, n_tasks = _deal(held, group, size, TASK_FILES)
    if n_tasks <= 1:
        tasks, n_tasks = _deal(held, group, size, _FEW_FILES)
    if n_tasks <= 1:
        return df.coalesce(1)
    places = df.sparkSession.createDataFrame(tasks, "_of string, _first int, _shares int")
    chance = F.pmod(F.xxhash64("_row"), F.col("_shares")).cast("int")
    return (
        df.withColumn("_row", F.monotonically_increasing_id())
        .join(F.broadcast(places), F.col(group).eqNullSafe(F.col("_of")))
        .withColumn("_task", F.col("_first") + chance)
        .repartitionById(n_tasks, "_task")
        .select(*df.columns)
    )


def _deal(
    sums: list[Row], group: str, size: int, task_files: int
) -> tuple[list[tuple[str, int, int]], int]:
    """For each group its first task and its number of tasks; the number of all tasks."""
    tasks, filled, first = [], 0.0, 0
    for row in sums:
        load = max(-(-row["n"] // size) / task_files, row["bytes"] / _TASK_BYTES)
        if filled and filled + load > 1:
            first, filled = first + 1, 0.0
        shares = max(ceil(load), 1)
        tasks.append((row[group], first, shares))
        first, filled = (first + shares, 0.0) if shares > 1 else (first, filled + load)
    return tasks, max((first + shares for _, first, shares in tasks), default=0)


class _Ranges:
    """Ranges of ordered rows, one for each task, known from the rows' keys alone.

    Range t begins at ``lows[t]`` (the group and the keys). Of the group it begins in, ``bases[t]``
    places lie in ranges before; of the one it ends in, ``ends[t]`` lie up to its end. A chunk
    belongs to the range its first place is in. If that is an earlier one, the rows up to
    ``highs[t]`` go to range ``owners[t]`` too.
    """

    def __init__(self, rows: list[dict], size: int) -> None:
        rows = sorted(rows, key=lambda r: r["place"])
        by_task: dict[int, list[dict]] = {}
        for r in rows:
            by_task.setdefault(r["task"], []).append(r)
        parts = list(by_task.values())
        self.lows = [p[0]["low"] for p in parts]
        self.bases = [p[0]["before"] for p in parts]
        self.ends = [p[-1]["end"] for p in parts]
        self.highs = [p[0]["high"] for p in parts]
        self.owners = []
        for t, high in enumerate(self.highs):
            owner = t
            if high is not None:
                first = self.bases[t] // size * size
                owner = t - 1
                while owner and self.bases[owner] > first and len(parts[owner]) == 1:
                    owner -= 1
            self.owners.append(owner)


def _literals(values: list, kind: T.DataType) -> Column:
    """The values as an array; a row becomes a struct."""

    def literal(value, kind: T.DataType) -> Column:
        if value is not None and isinstance(kind, T.StructType):
            return F.struct(
                *[literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind, strict=True)]
            )
        return F.lit(value).cast(kind)

    if not values:
        return F.array().cast(T.ArrayType(kind))
    return F.array(*[literal(v, kind) for v in values])


def ordered_chunks(
    df: DataFrame,
    group: str,
    order_by: str | Sequence[str],
    payload: str = "payload",
    copies: str | None = None,
    size: int = CHUNK_SIZE,
) -> DataFrame:
    """``encode_chunks`` of ``chunk_within``, or with ``copies`` of ``chunk_copies``, with the
    payloads shuffled once.

    Only the groups, keys and copies are numbered. That gives ranges of keys, one for each task,
    with the number their first row has. Payloads go to the task of their range, sorted by key,
    and get their numbers there, from the range's first one on. A chunk that two ranges
    share belongs to the one with its first place, which gets the rows it lacks, less than
    ``size`` places, a second time. Nothing is joined.

    Rows that tie are taken in the order of their payloads. ``df`` is read twice, so it should be
    stored, and has to give the same rows each time.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    weight = F.col(copies).cast("long") if copies else F.lit(1).cast("long")
    names = [f"_key{i}" for i in range(len(keys))]

    def key() -> Column:
        parts = [F.col(k).alias(n) for k, n in zip(keys, names, strict=True)]
        return F.struct(F.col(group).alias("_g"), *parts)

    slim = stage(
        df.select(
            F.col(group).alias("_g"),
            *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
            weight.alias("_n"),
        ),
        "keys",
    )
    # Chunks are files, which cost more than their bytes: ranges are as many as the files ask for.
    places = slim.agg(F.sum("_n")).first()[0] or 0
    ranges = min(max(places // (size * TASK_FILES), 1), _RANGES)
    placed = _place(slim, "_g", names, F.col("_n"), ranges)
    so_far = Window.partitionBy("_g", "_task").orderBy("_place").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    size_ = F.lit(int(size)).cast("long")
    shared = (F.col("_before") % size_ != 0) & (
        F.col("_end") - F.col("_n") < F.expr(f"(_before div {int(size)} + 1) * {int(size)}")
    )
    at = F.struct("_g", *names)
    found = (
        placed.withColumn("_end", F.col("_before") + F.sum("_n").over(so_far))
        .groupBy("_g", F.col("_task").alias("task"))
        .agg(
            F.min("_place").alias("place"),
            F.min_by(at, "_place").alias("low"),
            F.max_by(at, F.when(shared, F.col("_place"))).alias("high"),
            F.min("_before").alias("before"),
            F.max("_end").alias("end"),
        )
    )
    ranges = _Ranges([r.asDict() for r in found.collect()], size)
    kind = found.schema["low"].dataType
    lows, highs = _literals(ranges.lows, kind), _literals(ranges.highs, kind)
    n = max(len(ranges.lows), 1)
    # Bisection: the last range that does not begin behind the row.
    steps = [1 << i for i in reversed(range((n - 1).bit_length()))]
    own = F.aggregate(
        F.lit(steps) if steps else F.array().cast("array<int>"),
        F.lit(0),
        lambda found, step: F.when(
            F.try_element_at(lows, found + step + 1) <= F.col("_at"), found + step
        ).otherwise(found),
    )
    again = F.when(
        F.try_element_at(highs, F.col("_own") + 1) >= F.col("_at"),
        F.try_element_at(_literals(ranges.owners, T.IntegerType()), F.col("_own") + 1),
    )
    rows = df.select(
        F.col(group).alias(group),
        F.col(payload).alias("_payload"),
        weight.alias("_n"),
        key().alias("_at"),
    )
    dealt = (
        rows.withColumn("_own", own)
        .withColumn("_range", F.explode(F.array_compact(F.array(F.col("_own"), again))))
        .repartitionById(n, "_range")
    )
    before = Window.partitionBy("_range", group).orderBy("_at", "_payload").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )

    def of_range(values: list) -> Column:
        return F.try_element_at(_literals(values, T.LongType()), F.col("_range") + 1)

    starts_in = F.try_element_at(lows, F.col("_range") + 1)["_g"].eqNullSafe(F.col(group))
    base = F.when(starts_in, of_range(ranges.bases)).otherwise(F.lit(0).cast("long"))
    numbered = dealt.withColumn("_base", base).withColumns(
        {"_end": F.col("_base") + F.sum("_n").over(before)}
    )
    numbered = numbered.withColumn("_start", F.col("_end") - F.col("_n") + 1)
    if copies:
        pieces = _each(numbered, "chunk", _chunk("_start", size), _chunk("_end", size))
    else:
        pieces = numbered.withColumn("chunk", _chunk("_start", size))
    first = F.col("chunk") - 1
    pieces = pieces.withColumn("position", F.greatest("_start", first * size_ + 1)).withColumn(
        "_times", F.least("_end", F.col("chunk") * size_) - F.col("position") + 1
    )
    own_chunk = first * size_ >= F.col("_base")
    end = of_range(ranges.ends)
    kept = F.when(F.col("_own") == F.col("_range"), own_chunk).otherwise(first * size_ < end)
    mine = pieces.filter(kept).select(
        "_range", group, "chunk", "position", F.col("_payload").alias(payload), "_times"
    )
    return encode_chunks(mine, group, payload, "_times", "_range").drop("_range")


def encode_chunks(
    df: DataFrame,
    group: str,
    payload: str = "payload",
    copies: str | None = None,
    within: str | None = None,
) -> DataFrame:
    """One row per chunk: its documents in order as one JSON array, and their number.

    A group of this aggregation is one chunk, so it never exceeds the chunk size. ``within``
    names a column that is the same for all rows of a chunk and that they are dealt by.
    """
    times = (F.col(copies) if copies else F.lit(1)).cast("int")
    items = F.array_sort(
        F.collect_list(
            F.struct("position", F.col(payload).alias("json"), times.alias("times"))
        )
    )
    texts = F.flatten(F.transform(items, lambda i: F.array_repeat(i["json"], i["times"])))
    return df.groupBy(*([within] if within else []), group, "chunk").agg(
        F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")).alias("documents"),
        F.sum(times).alias("records"),
    )


def _chunk(position: str, size: int) -> Column:
    return F.expr(f"({position} - 1) div {int(size)} + 1")


def _each(df: DataFrame, name: str, first: Column, last: Column) -> DataFrame:
    """One row per number from ``first`` to ``last``, without a long list in any row."""
    block = F.lit(_RANGE_BLOCK)
    rows = df.withColumns({"_from": first, "_to": last})
    blocks = rows.withColumn(
        "_of", F.explode(F.sequence(F.floor(F.col("_from") / block), F.floor(F.col("_to") / block)))
    )
    numbers = F.sequence(
        F.greatest("_from", F.col("_of") * block),
        F.least("_to", F.col("_of") * block + block - 1),
    )
    return blocks.withColumn(name, F.explode(numbers)).drop("_from", "_to", "_of")
