"""Near-duplicate groups by b-bit MinHash.

Documents with equal shingle sets are one node. Minima of 64-bit hashes give band keys;
of each minimum only the low bits stay, packed into a short signature. Nodes that share
a band are candidates, and the collision-corrected share of equal low bits is their
estimated similarity. Whatever passes is confirmed on full sets.

Nothing grows with the square of a group of copies: exact copies are one node; in a
bucket only links that join all likely pairs are kept, which gives clusters of
candidates; within a cluster, blocks of bounded size are compared in tasks that return
the links that join two components and no others. A large cluster is first compared
with one of its blocks, and after that only what is outside its largest component is
compared with all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import groups, shuffle_partitions, stage, text_of
from .words import mix, set_key, shingle_sets

BITS = 4
BUCKET_BLOCK = 256
CLUSTER_BLOCK = 256
SALTS = 8
# Standard deviations of the estimate by which a pair may fall short of the threshold.
DEVIATIONS = 4.5

_EQUAL = np.array([(x & 15 == 0) + (x >> 4 == 0) for x in range(256)], dtype=np.uint8)


def minima(hashes: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The least value of the set under each of the multiplicative hash functions."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), 1024):
        part = hashes[i : i + 1024, None] * factors
        np.minimum(least, part.min(axis=0), out=least)
    return least


def signature(least: np.ndarray) -> bytes:
    """Four low bits of every minimum, two in a byte, after mixing."""
    low = (mix(least) & np.uint64(15)).astype(np.uint8)
    return (low[0::2] | (low[1::2] << 4)).tobytes()


def similarities(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity of a packed signature and rows of them.

    Unequal minima still agree in their low bits with probability 2**-BITS.
    """
    equal = _EQUAL[one ^ others].sum(axis=1, dtype=np.int64) / (2 * others.shape[1])
    chance = 2.0**-BITS
    return (equal - chance) / (1 - chance)


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


class Union:
    """Components of a few nodes."""

    def __init__(self, n: int) -> None:
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


def _likely_pairs(packed: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows whose estimate is ``least`` at least, the likeliest first."""
    left, right, score = [], [], []
    for i in range(len(packed) - 1):
        estimate = similarities(packed[i], packed[i + 1 :])
        good = np.flatnonzero(estimate >= least)
        left.append(np.full(len(good), i))
        right.append(good + i + 1)
        score.append(estimate[good])
    order = np.argsort(-np.concatenate(score), kind="stable")
    return np.concatenate(left)[order], np.concatenate(right)[order]


def _packed(column: pa.ChunkedArray) -> np.ndarray:
    return np.array([np.frombuffer(s, dtype=np.uint8) for s in column.to_pylist()])


class Stars:
    """Components of what one task has linked, as links to the least node of each."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)

    def links(self) -> Iterator[pa.RecordBatch]:
        nodes = [x for x in list(self.parent) if self.find(x) != x]
        for i in range(0, len(nodes), 50_000):
            part = nodes[i : i + 50_000]
            yield _links(part, [self.find(x) for x in part])


class NearDuplicates:
    """Groups of documents linked by ``share[1] * common >= share[0] * union`` shingles."""

    def __init__(
        self,
        shingle: int = 5,
        share: tuple[int, int] = (80, 100),
        bands: int = 25,
        rows: int = 5,
        seed: int = 7,
    ) -> None:
        self.shingle, self.share, self.bands, self.rows = shingle, share, bands, rows
        count = 2 * -(-bands * rows // 2)
        rng = np.random.default_rng(seed)
        self.factors = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        similarity = share[0] / share[1]
        self.least = similarity - DEVIATIONS * (similarity * (1 - similarity) / count) ** 0.5

    def sketches(self, texts: DataFrame) -> DataFrame:
        """Set key, size, signature and band keys of each text; for an empty set nulls."""
        k, bands, rows, factors = self.shingle, self.bands, self.rows, self.factors
        salt = mix(np.arange(1, bands + 1, dtype=np.uint64))
        weights = mix(np.arange(100, 100 + rows, dtype=np.uint64)) | np.uint64(1)

        def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, sizes, signatures, bucket_keys = [], [], [], []
                for found in shingle_sets(batch.column("text"), k):
                    sizes.append(len(found))
                    if not len(found):
                        keys.append(None)
                        signatures.append(None)
                        bucket_keys.append(None)
                        continue
                    least = minima(found, factors)
                    keys.append(set_key(found))
                    signatures.append(signature(least))
                    banded = least[: bands * rows].reshape(bands, rows) * weights
                    bucket_keys.append(mix(banded.sum(axis=1, dtype=np.uint64) ^ salt).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        batch.column("version"),
                        pa.array(keys, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.array(signatures, pa.binary()),
                        pa.array(bucket_keys, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "version", "set_key", "n_shingles", "signature", "buckets"],
                )

        return texts.mapInArrow(
            sketch,
            "doc_id long, version long, set_key binary, n_shingles long, signature binary, "
            "buckets array<long>",
        )

    def candidate_links(self, nodes: DataFrame) -> DataFrame:
        """Links of a forest that joins all nodes that share a bucket and may be similar.

        In buckets above ``BUCKET_BLOCK`` nodes, all are joined to one of them.
        """
        keyed = nodes.select("node", F.explode("buckets").alias("bucket"))
        held = keyed.groupBy("bucket").agg(F.count("*").alias("held"), F.min("node").alias("hub"))
        members = keyed.join(held.filter("held > 1"), "bucket")
        large = F.col("held") > BUCKET_BLOCK
        stars = members.filter(large & (F.col("node") != F.col("hub"))).select(
            F.col("node").alias("a"), F.col("hub").alias("b")
        )
        small = members.filter(~large).select("bucket", "node")
        least = self.least

        def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            stars = Stars()
            for group in groups(batches, ["bucket"]):
                nodes = group.column("node").to_pylist()
                union = Union(len(nodes))
                for i, j in zip(*_likely_pairs(_packed(group.column("signature")), least)):
                    if union.join(int(i), int(j)):
                        stars.join(nodes[i], nodes[j])
            yield from stars.links()

        likely = (
            small.join(nodes.select("node", "signature"), "node")
            .repartition(shuffle_partitions(nodes.sparkSession), "bucket")
            .sortWithinPartitions("bucket")
            .mapInArrow(forest, LINKS)
        )
        return likely.union(stars).distinct()

    def _sets(self, docs: DataFrame, nodes: DataFrame) -> DataFrame:
        """The full sets of the named nodes, from the texts of their documents."""
        k = self.shingle
        texts = docs.join(nodes.select("doc_id", "set_key", "node"), "doc_id")

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found_nodes, sets = [], []
                wanted = zip(batch.column("node").to_pylist(), batch.column("set_key").to_pylist())
                for (node, key), found in zip(wanted, shingle_sets(batch.column("text"), k)):
                    if key == set_key(found):  # else another text under the same number
                        found_nodes.append(node)
                        sets.append(found.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found_nodes, pa.int64()), pa.array(sets, pa.binary())],
                    ["node", "set"],
                )

        return texts.mapInArrow(read, "node long, set binary")

    def _confirm(self, blocks: DataFrame) -> DataFrame:
        """Confirmed links between different components within each group of rows.

        ``blocks`` has ``group, component, signature, set, node``. A group's rows come to
        one task; their number is bounded by two blocks.
        """
        least, (part, whole) = self.least, self.share

        def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            stars = Stars()
            for group in groups(batches, ["group"]):
                nodes = group.column("node").to_pylist()
                sets = [np.frombuffer(s, dtype=np.uint64) for s in group.column("set").to_pylist()]
                union, first = Union(len(nodes)), {}
                for i, component in enumerate(group.column("component").to_pylist()):
                    union.join(first.setdefault(component, i), i)
                for i, j in zip(*_likely_pairs(_packed(group.column("signature")), least)):
                    i, j = int(i), int(j)
                    if union.find(i) == union.find(j):
                        continue
                    x, y = sets[i], sets[j]
                    if whole * min(len(x), len(y)) < part * max(len(x), len(y)):
                        continue
                    common = shared(x, y)
                    if whole * common >= part * (len(x) + len(y) - common):
                        union.join(i, j)
                        stars.join(nodes[i], nodes[j])
            yield from stars.links()

        n = shuffle_partitions(blocks.sparkSession)
        return (
            blocks.repartition(2 * n, "group").sortWithinPartitions("group").mapInArrow(confirm, LINKS)
        )

    def confirmed(self, docs: DataFrame, nodes: DataFrame, links: DataFrame) -> DataFrame:
        """``node, component`` of every node that a confirmed link joins to another."""
        clusters = components(links)
        sized = clusters.groupBy("component").agg(F.count("*").alias("size"))
        blocks = F.ceil(F.col("size") / CLUSTER_BLOCK)
        members = stage(
            clusters.join(sized, "component")
            .select(
                F.col("component").alias("cluster"),
                "node",
                blocks.alias("blocks"),
                F.pmod(F.xxhash64("node"), blocks).alias("block"),
            )
            .join(nodes.drop("buckets"), "node"),
            "members",
        )
        sets = stage(self._sets(docs, members), "sets")
        full = members.drop("doc_id", "set_key").join(sets, "node")
        small = full.filter("blocks = 1").select(
            F.col("cluster").alias("group"), F.col("node").alias("component"), "signature", "set", "node"
        )
        # A small cluster is one group of one task, so these links are its components already.
        final = stage(self._confirm(small), "links")
        out = _labels(final)
        large = full.filter("blocks > 1")
        if members.filter("blocks > 1").isEmpty():
            return out
        # The first block meets each of the others, which meet nothing else.
        meets = F.when(
            F.col("block") == 0, F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1)
        ).otherwise(F.array("block"))
        first = large.withColumn("with", F.explode(meets)).select(
            F.xxhash64("cluster", "with").alias("group"),
            F.col("node").alias("component"),
            "signature",
            "set",
            "node",
        )
        found = stage(self._confirm(first), "links")
        slim = stage(
            members.filter("blocks > 1")
            .select("cluster", "node", "block", "blocks")
            .join(components(found), "node", "left")
            .withColumn("component", F.coalesce("component", "node")),
            "slim",
        )
        counted = slim.groupBy("cluster", "component").agg(F.count("*").alias("n"))
        main = counted.groupBy("cluster").agg(
            F.max_by("component", F.struct("n", "component")).alias("main"),
            (F.sum("n") - F.max("n")).alias("others"),
        )
        sides = slim.join(main.filter("others > 0"), "cluster").withColumn(
            "rest_blocks", F.ceil(F.col("others") / CLUSTER_BLOCK)
        )
        every = [F.sequence(F.lit(0).cast("long"), F.col(c) - 1) for c in ("rest_blocks", "blocks")]
        as_any = sides.withColumn("rest", F.explode(every[0])).withColumn("with", F.col("block"))
        as_rest = (
            sides.filter(F.col("component") != F.col("main"))
            .withColumn("rest", F.pmod(F.xxhash64("node", F.lit(1)), F.col("rest_blocks")))
            .withColumn("with", F.explode(every[1]))
        )
        names = ["cluster", "rest", "with", "node", "component"]
        second = (
            as_any.select(*names)
            .union(as_rest.select(*names))
            .join(large.select("node", "signature", "set"), "node")
            .withColumn("group", F.xxhash64("cluster", "rest", "with"))
            .select("group", "component", "signature", "set", "node")
        )
        return out.union(components(found.union(stage(self._confirm(second), "links"))))

    def groups(self, docs: DataFrame) -> DataFrame:
        """The component of each row of ``docs``, and whether the row is its first.

        Returns ``doc_id, n_shingles, component_id, kept``. ``docs`` has ``doc_id`` and ``text``; other columns are not read. Texts without
        words (null, empty, white space) have no shingles and are linked with nothing. A
        row without a number is linked with nothing and has no component, and is kept.
        Repeated rows stay repeated; rows that share a number but not a text are compared
        like any others. No rows give no rows.
        """
        return self._groups(docs).drop("version")

    def _groups(self, docs: DataFrame) -> DataFrame:
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        versions = texts.withColumn("version", F.xxhash64("text"))
        sketched = stage(self.sketches(versions), "sketches")
        linked = F.col("set_key").isNotNull() & F.col("doc_id").isNotNull()
        least = F.min_by(F.struct("signature", "buckets"), "doc_id").alias("of")
        nodes = stage(
            sketched.filter(linked)
            .groupBy("set_key")
            .agg(F.min("doc_id").alias("doc_id"), least)
            .select(F.monotonically_increasing_id().alias("node"), "set_key", "doc_id", "of.*"),
            "nodes",
        )
        links = stage(self.candidate_links(nodes), "links")
        members = nodes.select("node", "set_key", "doc_id")
        if links.isEmpty():
            members = members.withColumnRenamed("doc_id", "component_id")
        else:
            members = members.join(self.confirmed(texts, nodes, links), "node", "left").withColumn(
                "component", F.coalesce("component", "node")
            )
            smallest = members.groupBy("component").agg(F.min("doc_id").alias("component_id"))
            members = members.join(smallest, "component")
        members = members.select("set_key", "component_id")
        slim = sketched.select("doc_id", "version", "n_shingles", "set_key")
        names = ["doc_id", "version", "n_shingles", "component_id"]
        found = slim.filter(linked).join(members, "set_key").select(*names)
        alone = slim.filter(~linked).withColumn("component_id", F.col("doc_id")).select(*names)
        return found.union(alone).withColumn(
            "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
        )


    def keep_one(self, docs: DataFrame) -> DataFrame:
        """The rows of ``docs`` that are the first of their group, with all their columns.

        Of rows that share number and text one stays. Rows without a number or without
        words all stay.
        """
        found = stage(self._groups(docs).filter("n_shingles > 0 AND doc_id IS NOT NULL"), "groups")
        rows = docs.select(
            F.struct("*").alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.xxhash64(text_of()).alias("version"),
        )
        keys = ["doc_id", "version"]
        left = rows.join(found.filter("NOT kept").select(*keys).distinct(), keys, "left_anti")
        again = stage(
            found.filter("kept").groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1"), "again"
        )
        if not again.isEmpty():
            once = left.join(again.select(*keys), keys, "left_semi").dropDuplicates(keys)
            left = left.join(again.select(*keys), keys, "left_anti").unionByName(once)
        return left.select("row.*")


LINKS = "a long, b long"


def _links(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _labels(stars: DataFrame) -> DataFrame:
    """``node, component`` from links that lead to the least node of each component."""
    least = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(least)


def components(links: DataFrame) -> DataFrame:
    """``node, component`` of all nodes with links; a component is named by its least node.

    Rounds of large and small stars: each node passes its least neighbour to its larger
    neighbours, then to its smaller ones, until every node has one link, to a node that
    has none of its own.
    """

    def passed(edges: DataFrame, to_larger: bool) -> DataFrame:
        least = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        if to_larger:
            # A node may have very many larger neighbours: they are dealt out by a salt.
            salted = edges.filter("v > u").withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
            every = F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)]))
            joined = salted.join(least.withColumn("s", every), ["u", "s"])
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            joined = edges.join(least, "u")
            out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                least.select("u", F.col("m").alias("v"))
            )
        return out.filter("u <> v").distinct()

    def done(edges: DataFrame) -> bool:
        ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("out"), F.lit(0).alias("into"))
        ends = ends.union(edges.select("v", F.lit(0), F.lit(1)))
        held = ends.groupBy("node").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        return held.filter("out > 1 OR (out > 0 AND into > 0)").isEmpty()

    edges = stage(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    while not done(edges):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = stage(passed(passed(both, to_larger=True), to_larger=False), "stars")
    return _labels(edges.select(F.col("u").alias("a"), F.col("v").alias("b")))
