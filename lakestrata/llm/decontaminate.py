"""Benchmark items inside documents, by size-partitioned MinHash containment search.

Of an item's shingles those with the least hashes are its sketch. The sketch has
one more shingle than may be missing at the threshold, so a document that contains the
item has at least one of them: no candidate is lost, however long the document is.
Items are partitioned by the size of their sets; a document with fewer shingles than
the least of a partition has to share skips all of it. Candidates are confirmed by
the exact share of the item's shingles that the document has.

The benchmark is the query set: it is read in blocks of bounded size, each of which goes
to the tasks, which read every document in one narrow pass without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import text_of
from .words import MARKS, mix, runs_of, word_hashes

#: Characters of benchmark text in a block, about; a block is sent to every task.
BLOCK_CHARS = 16_000_000
_FILTER_BITS = 22

LEAKS = "doc_id long, item_id long, n_shingles long, shared long, containment double"


class ItemIndex:
    """The items of one block: shingle sets, sketches and partitions by size."""

    def __init__(self, items: list[tuple[int | None, str]], k: int, threshold: float) -> None:
        texts = pa.array([text for _, text in items], pa.string())
        words, index = word_hashes(texts, MARKS)
        self.ids: list[int | None] = []
        self.sets: list[np.ndarray] = []
        self.needed: list[int] = []
        # (length of a shingle, class of sizes) -> least shared shingles, sketch keys, items.
        found: dict[tuple[int, int], list[tuple[int, int]]] = {}
        least: dict[tuple[int, int], int] = {}
        for (item, _), start, end in zip(items, index[:-1].tolist(), index[1:].tolist()):
            n_words = end - start
            if not n_words:
                continue
            length = min(k, n_words)
            held = np.unique(runs_of(words[start:end], length))
            needed = max(math.ceil(threshold * len(held) - 1e-9), 1)
            part = (length, len(held).bit_length())
            least[part] = min(needed, least.get(part, needed))
            order = np.argsort(mix(held ^ np.uint64(0x5851F42D4C957F2D)))
            for h in held[order[: len(held) - needed + 1]].tolist():
                found.setdefault(part, []).append((h, len(self.ids)))
            self.ids.append(item)
            self.sets.append(held)
            self.needed.append(needed)
        self.parts = []
        for part, pairs in sorted(found.items()):
            pairs.sort()
            keys = np.array([h for h, _ in pairs], dtype=np.uint64)
            owners = np.array([i for _, i in pairs], dtype=np.int64)
            self.parts.append((part[0], least[part], keys, owners))
        self.filters: dict[int, np.ndarray] = {}
        for (length, _), pairs in found.items():
            table = self.filters.setdefault(length, np.zeros(1 << _FILTER_BITS, dtype=bool))
            for _, owner in pairs:
                table[self._slots(self.sets[owner])] = True

    @staticmethod
    def _slots(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)

    def matches(self, texts: pa.Array) -> Iterator[list[tuple[int, int]]]:
        """For each text the items it contains and how many of their shingles it has."""
        words, index = word_hashes(texts, MARKS)
        hits: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length, table in self.filters.items():
            runs = runs_of(words, length)
            at = np.flatnonzero(table[self._slots(runs)])
            hits[length] = (at, runs[at])
        for start, end in zip(index[:-1].tolist(), index[1:].tolist()):
            out: list[tuple[int, int]] = []
            mine: dict[int, np.ndarray] = {}
            for length, (at, values) in hits.items():
                low, high = np.searchsorted(at, (start, max(end - length + 1, start)))
                if low < high:
                    mine[length] = np.unique(values[low:high])
            for length, least, keys, owners in self.parts:
                if length not in mine or len(mine[length]) < least:
                    continue
                low = np.searchsorted(keys, mine[length], side="left")
                high = np.searchsorted(keys, mine[length], side="right")
                spans = [owners[a:b] for a, b in zip(low.tolist(), high.tolist()) if a < b]
                for owner in np.unique(np.concatenate(spans)).tolist() if spans else []:
                    shared = len(np.intersect1d(self.sets[owner], mine[length], assume_unique=True))
                    if shared >= self.needed[owner]:
                        out.append((owner, shared))
            yield out


def item_blocks(items: DataFrame, k: int, threshold: float) -> Iterator[ItemIndex]:
    """The benchmark in blocks; the query's plan holds all of them until it ends."""
    texts = items.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"))
    chars = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(math.ceil(chars / BLOCK_CHARS), 1)
    for block in range(blocks):
        mine = texts.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        yield ItemIndex([(r["item_id"], r["text"]) for r in mine.distinct().collect()], k, threshold)


def find_leaks(
    docs: DataFrame, items: DataFrame, k: int = 5, threshold: float = 0.8
) -> DataFrame:
    """``doc_id, item_id, n_shingles, shared, containment`` of each contained item.

    ``docs`` has ``doc_id`` and ``text``, ``items`` ``item_id`` and ``text``; other columns are
    not read. Words are runs of ASCII letters and digits, A-Z lower-cased, and of other
    characters beyond ASCII. An item with fewer than ``k`` words is one shingle of all its
    words; an item or a document without words contains and is contained in nothing.
    Repeated documents give repeated rows, equal items one. No rows give no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    out = None
    for index in item_blocks(items, k, threshold):
        part = texts.mapInArrow(_finder(index), LEAKS)
        out = part if out is None else out.union(part)
    return out


def _finder(index: ItemIndex):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            numbers = batch.column("doc_id").to_pylist()
            for doc, found in zip(numbers, index.matches(batch.column("text")), strict=True):
                for owner, shared in found:
                    n = len(index.sets[owner])
                    rows.append((doc, index.ids[owner], n, shared, shared / n))
            kinds = [pa.int64()] * 4 + [pa.float64()]
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                [c.split()[0] for c in LEAKS.split(", ")],
            )

    return find


def drop_leaks(docs: DataFrame, items: DataFrame, k: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns; a narrow filter.

    Null and empty texts contain none and stay, very long ones are searched whole. Repeated rows
    stay or go together; a null ``doc_id`` and columns of any name are kept. Items that repeat
    count once, items that are null or without words are in no text. No items drop no row, and
    no rows give no rows.
    """
    out = docs
    for index in item_blocks(items, k, threshold):
        rows = out.select(F.struct("*").alias("row"), text_of().alias("text"))
        out = rows.filter(~_contains(index)("text")).select("row.*")
    return out


def _contains(index: ItemIndex):
    @F.pandas_udf("boolean")
    def contains(texts: pd.Series) -> pd.Series:
        return pd.Series([bool(m) for m in index.matches(pa.array(texts, pa.string()))], dtype=bool)

    return contains
