"""A Merkle manifest of a dataset: leaf hashes of rows, trees of bounded fanout, proofs.

Slot pivot: nodes are numbered in order, ``fanout`` consecutive ones are a run, and a
conditional aggregate for each slot puts the nodes of a run side by side in ``fanout`` columns.
Concatenating the columns and hashing gives the parent; concatenating them without a node's
own slot gives its siblings. No tree is built outside of Spark: every level is one
aggregation with a fanout-th of the rows of the level below, and proofs go down the same way.

A tree may hold nearly all rows, so rows are numbered by ranges, not by a window over a tree,
and all joins are on a tree and a run. Only the greatest tree size and the root reach the
driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakestrata.operators.grouping import number_within

from .shared import stage

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "array<struct<left: string, right: string>>"


def encoded(value: Column) -> Column:
    """Length in UTF-8 bytes, a colon and the value as text; a dash for null."""
    text = value.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")
    )


def digest(*parts: Column) -> Column:
    """SHA-256 of the parts one after the other, as lowercase hex."""
    return F.sha2(F.concat(*parts), 256)


def _slots(fanout: int) -> list[Column]:
    return [F.coalesce(F.col(f"s{i}"), F.lit("")) for i in range(fanout)]


def _pivot(nodes: DataFrame, value: str, fanout: int, carried: dict[str, str]) -> DataFrame:
    """``tree, run, size`` and a column for each slot, from ``tree, place, size`` and the value.

    ``carried`` names further columns that are spread in the same way, with their prefixes.
    """
    slot = F.col("place") % fanout

    def spread(column: str, prefix: str) -> list[Column]:
        return [
            F.max(F.when(slot == i, F.col(column))).alias(f"{prefix}{i}") for i in range(fanout)
        ]

    wanted = [c for name, prefix in {value: "s", **carried}.items() for c in spread(name, prefix)]
    return nodes.groupBy("tree", F.expr(f"place div {fanout}").alias("run"), "size").agg(*wanted)


def _steps(runs: DataFrame, fanout: int, more: list[str]) -> DataFrame:
    """Every node of the runs, with what stands to its left and right in its run."""
    slots = _slots(fanout)

    def joined(parts: list[Column]) -> Column:
        return F.concat(*parts) if parts else F.lit("")

    nodes = F.array(
        *[
            F.struct(
                F.lit(i).alias("slot"),
                F.col(f"s{i}").alias("hash"),
                joined(slots[:i]).alias("left"),
                joined(slots[i + 1 :]).alias("right"),
                *[F.col(f"{prefix}{i}").alias(prefix) for prefix in more],
            )
            for i in range(fanout)
        ]
    )
    kept = [c for c in runs.columns if c.rstrip("0123456789") not in ("s", *more)]
    return (
        runs.select(*kept, F.explode(nodes).alias("node"))
        .filter("node.hash IS NOT NULL")
        .select(*kept, "node.*")
    )


class Forest:
    """Trees over numbered leaves; ``levels`` holds the runs of each level, the lowest first."""

    def __init__(
        self, leaves: DataFrame, fanout: int = FANOUT, carried: dict[str, str] | None = None
    ) -> None:
        """``leaves`` has ``tree``, ``place`` (from 0), ``hash`` and the carried columns."""
        self.fanout = fanout
        self.carried = carried or {}
        sizes = stage(leaves.groupBy("tree").agg(F.count("*").alias("size")), "trees")
        self.sizes = sizes
        self.largest = sizes.agg(F.max("size")).first()[0] or 0
        runs = _pivot(leaves.withColumn("size", F.lit(0)), "hash", fanout, self.carried)
        lowest = runs.drop("size").join(sizes, "tree")
        self.levels = [stage(lowest.withColumn("hash", digest(*_slots(fanout))), "runs")]
        while self.largest > fanout ** len(self.levels):
            below = self.levels[-1].filter(F.col("size") > fanout ** len(self.levels))
            nodes = below.select("tree", F.col("run").alias("place"), "size", "hash")
            runs = _pivot(nodes, "hash", fanout, {})
            self.levels.append(stage(runs.withColumn("hash", digest(*_slots(fanout))), "runs"))

    def tops(self) -> DataFrame:
        """``tree, hash`` of what remains of each tree; a lone leaf remains itself."""
        lone = self.levels[0].filter("size = 1").select("tree", F.col("s0").alias("hash"))
        ends = [
            level.filter(self._ends(i)).select("tree", "hash")
            for i, level in enumerate(self.levels, start=1)
        ]
        return reduce(DataFrame.unionByName, ends, lone)

    def _ends(self, level: int) -> Column:
        low = max(self.fanout ** (level - 1), 1)
        return (F.col("size") > low) & (F.col("size") <= self.fanout**level)

    def paths(self, above: DataFrame) -> DataFrame:
        """The leaves with their steps up to the top of their tree and beyond.

        ``above`` has for each tree ``path``, the steps from its top upwards, and any further
        columns, which all leaves of the tree get.
        """
        known = [c for c in above.columns if c not in ("tree", "path")]
        sized = above.join(self.sizes, "tree")
        found = None
        for level in reversed(range(1, len(self.levels) + 1)):
            ends = self._ends(level) if level > 1 else F.col("size") <= self.fanout
            here = sized.filter(ends).select("tree", F.lit(0).cast("long").alias("run"), "path", *known)
            if found is not None:
                here = here.unionByName(found)
            runs = self.levels[level - 1]
            if level > 1:
                runs = runs.drop("hash", "size")
                steps = _steps(runs.join(here, ["tree", "run"]), self.fanout, [])
                found = steps.select(
                    "tree",
                    (F.col("run") * self.fanout + F.col("slot")).alias("run"),
                    F.concat(F.array(F.struct("left", "right")), "path").cast(_STEP).alias("path"),
                    *known,
                )
                continue
            # The steps above are the same for all leaves of a run; so is their text.
            siblings = F.array_join(
                F.transform("path", lambda p: F.concat(p["left"], p["right"])), ""
            )
            joined = runs.drop("hash").join(here.withColumn("siblings", siblings), ["tree", "run"])
            leaves = _steps(joined, self.fanout, list(self.carried.values()))
            names = {prefix: name for name, prefix in self.carried.items()}
            lone = F.col("size") == 1
            own = F.array(F.struct("left", "right")).cast(_STEP)
            return leaves.select(
                "tree",
                "hash",
                *[F.col(prefix).alias(name) for prefix, name in names.items()],
                F.concat(F.when(lone, F.array().cast(_STEP)).otherwise(own), "path").alias("path"),
                F.concat("left", "right", "siblings").alias("siblings"),
                *known,
            )
        raise AssertionError("a forest has a level")


def fold(value: Column, path: str) -> Column:
    """The hash at the end of a path: each step hashes left siblings, the value, right ones."""
    return F.aggregate(path, value, lambda held, p: digest(p["left"], held, p["right"]))


def leaves(docs: DataFrame, tampered: Column, tampered_text: Column) -> DataFrame:
    """``doc_id, tree, hash, other``: leaves, and what they would be of the tampered text.

    ``other`` is null for rows that are not tampered with. Trees are the sources, so named that
    their order as text is null first, then by the bytes of the source.
    """
    source = F.col("source").cast("string")
    fields = {name: encoded(F.col(name)) for name in FIELDS}
    other = {**fields, "text": encoded(tampered_text)}
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), source), F.lit("-")).alias("tree"),
        digest(*fields.values()).alias("hash"),
        F.when(F.coalesce(tampered, F.lit(False)), digest(*other.values())).alias("other"),
    )


def manifest(
    docs: DataFrame,
    tampered: Column | None = None,
    tampered_text: Column | None = None,
    fanout: int = FANOUT,
) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and the root its proof folds to.

    ``docs`` has the columns ``FIELDS``; other columns are not read. Leaves are ordered by
    ``doc_id`` within their source (null numbers first, equal ones by their leaves) and sources
    by their bytes, null first. A null field is a dash, so null and empty text differ. Rows that
    repeat are leaves each. A lone leaf is its source's subroot, and a lone subroot the root.
    No rows give no rows.

    Rows where ``tampered`` holds are folded from the leaf they have with ``tampered_text`` in
    place of their text; ``verified`` says whether the folded root is the root.

    Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.
    """
    rows = leaves(
        docs,
        F.lit(False) if tampered is None else tampered,
        F.col("text") if tampered_text is None else tampered_text,
    )
    # Hashed once: numbering reads its rows twice.
    numbered = number_within(stage(rows, "leaves"), "tree", ["doc_id", "hash"], "place")
    sources = Forest(
        numbered.withColumn("place", F.col("place") - 1), fanout, {"doc_id": "d", "other": "t"}
    )
    if not sources.largest:
        return _result(rows.limit(0).withColumns({"path": F.array().cast(_STEP), "siblings": F.lit("")}), "")
    tops = sources.tops().withColumn("all", F.lit(""))
    subroots = number_within(stage(tops, "subroots"), "all", "tree", "place").select(
        F.lit("").alias("tree"),
        (F.col("place") - 1).alias("place"),
        "hash",
        F.col("tree").alias("source"),
    )
    whole = Forest(subroots, fanout, {"source": "n"})
    root = whole.tops().first()["hash"]
    start = docs.sparkSession.range(1).select(
        F.lit("").alias("tree"), F.array().cast(_STEP).alias("path")
    )
    above = whole.paths(start).select(
        F.col("source").alias("tree"), "path", F.col("hash").alias("subroot")
    )
    return _result(sources.paths(stage(above, "sources")), root)


def _result(found: DataFrame, root: str) -> DataFrame:
    if "subroot" not in found.columns:
        found = found.withColumn("subroot", F.col("hash"))
    folded = fold(F.coalesce("other", "hash"), "path")
    return found.select(
        "doc_id",
        F.col("hash").alias("leaf"),
        "subroot",
        F.lit(root).alias("root"),
        F.sha2("siblings", 256).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
