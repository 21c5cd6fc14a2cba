"""Hard negatives by exact integer scores, several candidates to one multiplication.

Kronecker packing: components of several candidates are made non-negative by a bias and
put into separate fields of one wide integer. One multiplication of that integer by a
component of an anchor multiplies all of them, sums over components stay in their
fields, and the exact scores are unpacked and the biases taken off. While a packed sum has
at most 53 bits, it is exact as a double too, so the multiplications of a block of anchors
are one matrix product; components too large for that are packed into Python's integers.

Anchors are a stated query set, compared with all rows in blocks: rows are dealt to groups of
bounded size, anchors go to every group, and a task holds its group and one block of
anchors. Each task gives its best few rows for each anchor, and the best of those are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import shuffle_partitions, stage

# Integers up to this many bits are exact in a double, and so are their sums.
EXACT_BITS = 53
WIDE_FIELDS = 16
GROUP_VALUES = 1 << 23
CHUNK_ROWS = 8_192
ANCHOR_ROWS = 256
_LONG = 2**63

POSITIVES = "anchor long, positive_id long, positive_score long"
NEGATIVES = (
    "anchor long, anchor_id long, place int, positive_id long, positive_score long,"
    " negative_id long, negative_score long"
)
_KINDS = {"long": pa.int64(), "int": pa.int32()}


def _integers(values: np.ndarray) -> np.ndarray:
    return np.vectorize(int, otypes=[object])(values) if values.size else values.astype(object)


class Side:
    """Integer vectors as rows of doubles, made non-negative by one bias."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        self.bias = max(0, -int(values.min())) if values.size else 0
        self.top = int(values.max()) + self.bias if values.size else 0

    def shifted(self, exact: bool) -> np.ndarray:
        if exact:
            return self.values + float(self.bias)
        return _integers(self.values) + self.bias

    def sums(self, exact: bool) -> np.ndarray:
        if exact:
            return self.values.sum(axis=1).astype(np.int64)
        return _integers(self.values).sum(axis=1)


def field_bits(dims: int, a: Side, b: Side) -> int:
    """Bits that hold any sum of products of two shifted rows.

    The anchors' side counts up to its next power of two, so that blocks of anchors that
    differ little need one packing.
    """
    top = (1 << max(b.top, 1).bit_length()) - 1
    return (max(dims, 1) * max(a.top, 1) * top).bit_length()


class Candidates(Side):
    """Rows of one label, by ascending number, that are packed for products with anchors."""

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        super().__init__(values)
        self.ids = ids
        self.words: dict[int, np.ndarray] = {}

    def packed(self, bits: int, fields: int, exact: bool) -> np.ndarray:
        """One column for each wide integer: the candidates j, j + n, j + 2n .. of n integers."""
        if bits not in self.words:
            n = -(-len(self.ids) // fields)
            rows = self.shifted(exact)
            words = np.zeros((n, rows.shape[1]), dtype=rows.dtype)
            for field in range(fields):
                part = rows[field * n : (field + 1) * n]
                words[: len(part)] += part * (2.0 ** (bits * field) if exact else 1 << bits * field)
            self.words = {bits: np.ascontiguousarray(words.T)}
        return self.words[bits]

    def scores(self, anchors: Side) -> np.ndarray:
        """Inner products of all anchors (rows) with all candidates (columns), as longs.

        A product that no long can hold counts as the nearest long.
        """
        bits = field_bits(self.values.shape[1], self, anchors)
        exact = bits <= EXACT_BITS
        fields = EXACT_BITS // bits if exact else WIDE_FIELDS
        left = anchors.shifted(exact)
        product = left @ self.packed(bits, fields, exact)
        if exact:
            product = product.astype(np.int64)
        mask = (1 << bits) - 1
        unpacked = [(product >> (bits * field)) & mask for field in range(fields)]
        found = np.concatenate(unpacked, axis=1)[:, : len(self.ids)]
        of_anchors = left.sum(axis=1)
        if exact:
            of_anchors = of_anchors.astype(np.int64)
        found = found - (self.bias * of_anchors)[:, None]
        found = found - anchors.bias * self.sums(exact)[None, :]
        return found if exact else np.clip(found, -_LONG, _LONG - 1).astype(np.int64)


def matrix(vectors: pa.Array, dims: int | None = None) -> np.ndarray:
    """``floor(256 * x)`` of each component; shorter vectors end in zeros, longer ones are cut."""
    offsets = vectors.offsets.to_numpy()
    values = vectors.values.to_numpy(zero_copy_only=False).astype(np.float64)
    values = np.floor(values[offsets[0] : offsets[-1]] * 256.0)
    sizes = np.diff(offsets)
    width = int(sizes.max()) if dims is None and len(sizes) else dims or 0
    if (sizes == width).all():
        return values.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    for row, n, start in zip(out, sizes.tolist(), (offsets[:-1] - offsets[0]).tolist(), strict=True):
        row[: min(n, width)] = values[start : start + min(n, width)]
    return out


def first_of_equals(ids: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Which rows of one label can be among the first ``k``; ``ids`` ascend.

    Equal vectors have equal scores, so smaller numbers come first: of each vector the rows of
    the ``k + 1`` smallest numbers (one may be the anchor's own) suffice, ``k`` rows of each.
    """
    # For each vector its last number, how many numbers it had so far, and rows of the last one.
    held: dict[bytes, tuple[int, int, int]] = {}
    kept = []
    for i, (number, row) in enumerate(zip(ids.tolist(), values, strict=True)):
        vector = row.tobytes()
        last, numbers, rows = held.get(vector, (None, 0, 0))
        numbers, rows = (numbers, rows + 1) if last == number else (numbers + 1, 1)
        held[vector] = number, numbers, rows
        if numbers <= k + 1 and rows <= k:
            kept.append(i)
    return np.array(kept, dtype=np.int64)


def best(rows: np.ndarray, columns: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each row: higher scores, then smaller columns, first."""
    order = np.lexsort((columns, ~scores, rows))
    sorted_rows = rows[order]
    fresh = np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]])[: len(order)]
    starts = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))
    return order[np.arange(len(order)) - starts < k]


class Group:
    """The candidates of one group, by label, in chunks."""

    def __init__(self, table: pa.Table, k: int) -> None:
        table = table.combine_chunks()
        labels, ids = (table.column(c).to_numpy() for c in ("label", "vec_id"))
        vectors = table.column("vector").combine_chunks()
        values = matrix(vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors)
        self.dims = values.shape[1]
        self.chunks: list[tuple[int, Candidates]] = []
        for label in np.unique(labels).tolist():
            mine = np.flatnonzero(labels == label)
            mine = mine[np.argsort(ids[mine], kind="stable")]
            mine = mine[first_of_equals(ids[mine], values[mine], k)]
            for i in range(0, len(mine), CHUNK_ROWS):
                part = mine[i : i + CHUNK_ROWS]
                self.chunks.append((label, Candidates(ids[part], values[part])))

    def positives(self, anchors: pa.Table, k: int) -> list[np.ndarray]:
        """For each anchor the best ``k`` other rows of its label in this group."""
        labels, own = (anchors.column(c).to_numpy() for c in ("label", "vec_id"))
        numbers = anchors.column("anchor").to_numpy()
        values = matrix(anchors.column("vector").combine_chunks(), self.dims)
        out = []
        for label, chunk in self.chunks:
            at = np.flatnonzero(labels == label)
            if not len(at):
                continue
            scores = chunk.scores(Side(values[at]))
            other = chunk.ids[None, :] != own[at][:, None]
            if scores.shape[1] > k:
                # Nothing below the k-th best other score can be among the first k.
                limit = np.where(other, scores, -_LONG)
                kth = np.partition(limit, -k, axis=1)[:, -k]
                other &= scores >= kth[:, None]
            rows, columns = np.nonzero(other)
            kept = best(rows, columns, scores[rows, columns], k)
            rows, columns = rows[kept], columns[kept]
            out.append([numbers[at[rows]], chunk.ids[columns], scores[rows, columns]])
        return [np.concatenate(c) for c in zip(*out)] if out else []

    def negatives(self, anchors: pa.Table, k: int, share: tuple[int, int]) -> list[np.ndarray]:
        """For each anchor and positive the best ``k`` rows of other labels within the window."""
        labels, own, numbers = (
            anchors.column(c).to_numpy() for c in ("label", "vec_id", "anchor")
        )
        values = matrix(anchors.column("vector").combine_chunks(), self.dims)
        pairs = anchors.column("positives").to_pylist()
        places = max(map(len, pairs), default=0)
        # No score lies in the window of a negative positive score, or of a place not taken.
        lower = np.full((len(pairs), places), 1, dtype=np.int64)
        upper = np.zeros((len(pairs), places), dtype=np.int64)
        named = np.zeros((len(pairs), places), dtype=np.int64)
        for i, pair in enumerate(pairs):
            for place, p in enumerate(pair):
                score = p["positive_score"]
                named[i, place] = p["positive_id"]
                if score >= 0:
                    lower[i, place], upper[i, place] = -(-score * share[0] // share[1]), score
        some = np.flatnonzero((lower <= upper).any(axis=1))
        if not len(some):
            return []
        lowest = np.where(lower <= upper, lower, _LONG - 1).min(axis=1)
        highest = upper.max(axis=1)
        side = Side(values[some])
        out = []
        for label, chunk in self.chunks:
            scores = chunk.scores(side)
            near = (scores >= lowest[some][:, None]) & (scores <= highest[some][:, None])
            near &= (labels[some] != label)[:, None]
            rows, columns = np.nonzero(near)
            found, rows = scores[rows, columns], some[rows]
            for place in range(places):
                inside = np.flatnonzero((found >= lower[rows, place]) & (found <= upper[rows, place]))
                kept = inside[best(rows[inside], columns[inside], found[inside], k)]
                r = rows[kept]
                out.append(
                    [
                        numbers[r],
                        own[r],
                        np.full(len(r), place, dtype=np.int32),
                        named[r, place],
                        upper[r, place],
                        chunk.ids[columns[kept]],
                        found[kept],
                    ]
                )
        return [np.concatenate(c) for c in zip(*out)] if out else []


def _over_groups(candidates: DataFrame, anchors: DataFrame, groups: int, schema: str, k: int, step):
    """``step`` on every block of anchors with every group of candidates.

    A partition holds one group: its candidates first, then all anchors, block after block.
    """
    rows = candidates.withColumns(
        {
            "group": F.pmod(F.monotonically_increasing_id(), F.lit(groups)).cast("int"),
            "is_anchor": F.lit(False),
            "anchor": F.lit(None).cast("long"),
            "positives": F.lit(None).cast(anchors.schema["positives"].dataType),
        }
    )
    queries = anchors.withColumns(
        {
            "group": F.explode(F.sequence(F.lit(0), F.lit(groups - 1))),
            "is_anchor": F.lit(True),
        }
    )
    names = ["group", "is_anchor", "anchor", "vec_id", "label", "vector", "positives"]
    dealt = (
        rows.select(*names)
        .unionByName(queries.select(*names))
        .repartitionById(groups, "group")
        .sortWithinPartitions("is_anchor")
    )
    fields = [f.strip().split() for f in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        group = None
        for batch in batches:
            asked = batch.column("is_anchor").to_numpy(zero_copy_only=False)
            split = int(np.searchsorted(asked, True))
            if split:
                held.append(batch.slice(0, split))
            for i in range(split, batch.num_rows, ANCHOR_ROWS):
                if group is None:
                    if not held:
                        break
                    group = Group(pa.Table.from_batches(held), k)
                    held = []
                block = pa.Table.from_batches([batch.slice(i, min(ANCHOR_ROWS, batch.num_rows - i))])
                columns = step(group, block)
                if columns and len(columns[0]):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, _KINDS[t]) for c, (_, t) in zip(columns, fields, strict=True)],
                        [name for name, _ in fields],
                    )

    return dealt.mapInArrow(run, schema)


def taking_part(vectors: DataFrame, label: Column) -> DataFrame:
    """``vec_id, label, vector`` of the rows with all of them and only finite components.

    A component is finite if 256 times it is.
    """
    kind = vectors.schema["embedding"].dataType
    if not isinstance(kind, T.ArrayType):
        raise TypeError("embedding has to be an array of numbers")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.col("embedding").alias("vector"),
    )
    finite = F.forall(
        "vector",
        lambda x: x.isNotNull() & (F.abs(x.cast("double") * 256.0) < F.lit(float("inf"))),
    )
    return rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").filter(finite)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (80, 100),
    group_values: int = GROUP_VALUES,
) -> DataFrame:
    """The best-scoring rows of other labels for each anchor and each of its positives.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; ``is_anchor`` and ``label`` may read
    any of its columns. A score is the inner product of the vectors with each component x as
    floor(256 * x); a vector that is shorter than another ends in zeros, one without components
    scores 0. An anchor's positives are its first ``positives`` other rows of its label, and a
    positive's negatives the first ``negatives`` rows of other labels with ``share`` of the
    positive's score at least and that score at most; all, if there are fewer. A positive with
    a negative score has none. Higher scores come first, then smaller numbers.

    Rows with a null number, label, vector or component, or a component that is not finite, take
    no part. Rows with the anchor's number are not other rows. Rows that repeat are rows each, as
    candidates and as anchors. No anchors, or no rows, give no rows.

    Returns ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.
    """
    spark = vectors.sparkSession
    label = F.col("label") if label is None else label
    rows = taking_part(vectors, label)
    asked = taking_part(vectors.filter(F.coalesce(is_anchor, F.lit(False))), label)
    pair = "array<struct<positive_score: long, positive_id: long>>"
    anchors = stage(
        asked.withColumns(
            {"anchor": F.monotonically_increasing_id(), "positives": F.lit(None).cast(pair)}
        ),
        "anchors",
    )
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dims")).first()
    groups = max(shuffle_partitions(spark), -(-size["n"] * max(size["dims"] or 0, 1) // group_values))

    near = _over_groups(
        rows, anchors, groups, POSITIVES, positives, lambda g, block: g.positives(block, positives)
    )
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id")
    first = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= positives)
    listed = first.groupBy("anchor").agg(
        F.sort_array(
            F.collect_list(F.struct("positive_score", "positive_id")), asc=False
        ).alias("positives")
    )
    with_positives = stage(
        anchors.drop("positives").join(listed, "anchor").select(*anchors.columns), "positives"
    )

    far = _over_groups(
        rows,
        with_positives,
        groups,
        NEGATIVES,
        negatives,
        lambda g, block: g.negatives(block, negatives, share),
    )
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id")
    return (
        far.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= negatives)
        .select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        )
    )
