"""Best-fit packing of token sequences, with large items matched in pairs.

At most two items above a third of the capacity fit in one bin, so those are
matched greedily, the longest first, each with the longest that still fits. The
others fill the gaps, longest first, each into the smallest gap that holds it.

There are at most ``capacity`` different lengths. The plan is therefore made on
the counts by length (bounded by the capacity, whatever the data): it is a list of
bin patterns and how many bins have each. Items then look up their place by length
and by their rank among the items of that length. Ranks come from the order in which
tasks wrote the items, so no task needs all items of a length, however common it is.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import stage, text_of
from .tokenize import MEMO, encoder

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, "
    "task int, rank_in_task long"
)


@dataclass
class Bins:
    """``count`` bins that all hold items of these lengths, in this order."""

    lengths: tuple[int, ...]
    count: int


def plan_bins(counts: dict[int, int], capacity: int) -> list[Bins]:
    """Bin patterns that take exactly the counted items."""
    if any(n < 1 or n > capacity for n in counts):
        raise ValueError("an item is empty or longer than a bin")
    left = {n: c for n, c in counts.items() if c > 0}
    large = sorted(n for n in left if 3 * n > capacity)
    bins: list[Bins] = []
    while large:
        n = large[-1]
        fits = bisect.bisect_right(large, capacity - n)
        if not fits:
            bins.append(Bins((n,), left.pop(n)))
            large.pop()
            continue
        mate = large[fits - 1]
        if mate == n:
            pairs, odd = divmod(left.pop(n), 2)
            large.pop()
            if pairs:
                bins.append(Bins((n, n), pairs))
            if odd and large:
                left_mate = large[-1]
                bins.append(Bins((n, left_mate), 1))
                left[left_mate] -= 1
                if not left[left_mate]:
                    del left[left_mate]
                    large.pop()
            elif odd:
                bins.append(Bins((n,), 1))
            continue
        both = min(left[n], left[mate])
        bins.append(Bins((n, mate), both))
        for x in (n, mate):
            left[x] -= both
            if not left[x]:
                del left[x]
                large.remove(x)
    return _fill(bins, left, capacity)


def _fill(bins: list[Bins], small: dict[int, int], capacity: int) -> list[Bins]:
    """Best fit of the small items, longest first, into gaps and then new bins."""
    by_gap: dict[int, list[Bins]] = {}
    for b in bins:
        by_gap.setdefault(capacity - sum(b.lengths), []).append(b)
    gaps = sorted(by_gap)
    for n in sorted(small, reverse=True):
        todo = small[n]
        while todo:
            at = bisect.bisect_left(gaps, n)
            if at == len(gaps):
                gap, group = capacity, Bins((), -(-todo // (capacity // n)))
            else:
                gap = gaps[at]
                group = by_gap[gap].pop()
                if not by_gap[gap]:
                    del by_gap[gap], gaps[at]
            # The smallest gap that holds the item stays the one just used until it is full.
            each = gap // n
            full = min(group.count, todo // each)
            rest = todo - full * each if full < group.count else 0
            filled = [(full, each)] if full else []
            if 0 < rest < each:
                filled.append((1, rest))
            used = 0
            for count, items in filled:
                used += count
                todo -= count * items
                new = gap - items * n
                if new not in by_gap:
                    bisect.insort(gaps, new)
                by_gap.setdefault(new, []).append(Bins(group.lengths + (n,) * items, count))
            if gap < capacity or group.lengths:
                if group.count > used:
                    if gap not in by_gap:
                        bisect.insort(gaps, gap)
                    by_gap.setdefault(gap, []).append(Bins(group.lengths, group.count - used))
    return [b for group in by_gap.values() for b in group]


class Places:
    """Where the item of a length and rank goes: its sequence and its offset there."""

    def __init__(self, bins: list[Bins]) -> None:
        slots: dict[int, list[tuple[int, int, int, int]]] = {}
        taken: dict[int, int] = {}
        first = 0
        for b in bins:
            offset = 0
            for n in b.lengths:
                at = taken.get(n, 0)
                slots.setdefault(n, []).append((at, first, offset, b.count))
                taken[n] = at + b.count
                offset += n
            first += b.count
        self.slots = {n: np.array(s, dtype=np.int64) for n, s in slots.items()}

    def find(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.zeros_like(ranks), np.zeros_like(ranks)
        for n in np.unique(lengths):
            mine = np.flatnonzero(lengths == n)
            table = self.slots[int(n)]
            slot = np.searchsorted(table[:, 0], ranks[mine], side="right") - 1
            sequence[mine] = table[slot, 1] + ranks[mine] - table[slot, 0]
            offset[mine] = table[slot, 2]
        return sequence, offset


def cut_tokens(
    docs: DataFrame,
    vocabulary: str,
    capacity: int,
    end_id: int,
    keep_ids: bool = False,
    memo: int = MEMO,
) -> DataFrame:
    """One row for each piece of a document's ids, which ``end_id`` ends."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, memo).encoded
        task = TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = []
            ids_of = batch.column(0).to_pylist()
            for doc, raw in zip(ids_of, encode(batch.column(1)), strict=True):
                raw += end
                for piece, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at : at + 4 * capacity]
                    n = len(part) // 4
                    rank = seen.get(n, 0)
                    seen[n] = rank + 1
                    kept = part if keep_ids else None
                    rows.append((doc, piece, at // 4, n, zlib.crc32(part), kept, task, rank))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), _ARROW, strict=True)], _NAMES
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return texts.mapInArrow(pieces, PIECES)


_NAMES = [part.strip().split()[0] for part in PIECES.split(",")]
_ARROW = [
    {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[part.strip().split()[1]]
    for part in PIECES.split(",")
]


def place_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to stored pieces of ``cut_tokens``.

    ``task`` and ``rank_in_task`` have to be stored with the pieces: a task that
    runs again could number them otherwise.
    """
    held = pieces.groupBy("task", "length").agg(F.count("*").alias("held"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = held.withColumn("base", F.coalesce(F.sum("held").over(before), F.lit(0))).drop("held")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = Places(plan_bins(counts, capacity))
    ranked = pieces.join(bases, ["task", "length"]).withColumn(
        "rank", F.col("base") + F.col("rank_in_task")
    )

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        s, o = places.find(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": s, "offset": o})

    return ranked.withColumn("place", place("length", "rank")).select(
        *[c for c in pieces.columns if c not in ("task", "rank_in_task")],
        "place.sequence_id",
        "place.offset",
    )


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 4096,
    end_id: int = 1,
    keep_ids: bool = False,
    memo: int = MEMO,
) -> DataFrame:
    """Packs documents into as few sequences of at most ``capacity`` ids as it can.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A document is
    the ids of its text, then ``end_id``; a null or empty text is ``end_id`` alone. Only
    longer documents are cut, into pieces of ``capacity``. Rows that repeat are packed
    as often as they occur; a null ``doc_id`` stays null. No rows give no rows.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` and, with
    ``keep_ids``, ``ids`` for ``sequences``. ``memo`` bounds the words that a worker remembers:
    fewer take less memory and more time.
    """
    pieces = stage(cut_tokens(docs, vocabulary, capacity, end_id, keep_ids, memo), "pieces")
    placed = place_pieces(pieces, capacity)
    return placed if keep_ids else placed.drop("ids")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids, one row for each sequence; a group is bounded by the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "length")))
    whole = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    joined = F.aggregate(
        "parts", F.lit(b"").cast("binary"), lambda raw, p: F.concat(raw, p["ids"])
    )
    n = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["length"])
    return whole.select("sequence_id", joined.alias("ids"), n.alias("length"))
