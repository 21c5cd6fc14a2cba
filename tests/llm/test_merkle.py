"""Manifests against plain trees."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lakestrata.llm import merkle
from lakestrata.llm.shared import in_fold

from .helpers import DOCUMENTS

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def lower(text):
    return text and "".join(c.lower() if c.isascii() else c for c in text)


def tree(nodes, fanout):
    """The root and, for each node, what stands left and right of it on every level."""
    paths = [[] for _ in nodes]
    below = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + fanout, len(nodes))) for i in range(0, len(nodes), fanout)]
        for run in runs:
            for i in run:
                step = ("".join(nodes[run[0] : i]), "".join(nodes[i + 1 : run[-1] + 1]))
                for member in below[i]:
                    paths[member].append(step)
        nodes = [sha("".join(nodes[r[0] : r[-1] + 1])) for r in runs]
        below = [sum((below[i] for i in r), []) for r in runs]
    return nodes[0], paths


def plain(rows, fanout=16):
    sources = defaultdict(list)
    for doc, text, lang, source, n in rows:
        bad = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0
        own = leaf(doc, source, lang, n, text)
        other = leaf(doc, source, lang, n, lower(text)) if bad else own
        sources[source].append(((doc is not None, doc or 0, own), doc, own, other))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([r[2] for r in sorted(sources[s], key=lambda r: r[0])], fanout) for s in order}
    root, above = tree([trees[s][0] for s in order], fanout) if order else ("", [])
    out = Counter()
    for s, tops in zip(order, above, strict=True):
        for (_, doc, own, other), path in zip(sorted(sources[s], key=lambda r: r[0]), trees[s][1], strict=True):
            folded = other
            for left, right in path + tops:
                folded = sha(left + folded + right)
            proof = sha("".join(left + right for left, right in path + tops))
            out[doc, own, trees[s][0], root, proof, folded, folded == root] += 1
    return out


def made(spark, rows, fanout=16):
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(5)
    docs = docs.selectExpr("*", "1 AS tree", "2 AS place", "3 AS size", "4 AS hash", "5 AS s0", "6 AS path")
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    got = merkle.manifest(docs, in_fold(F.col("doc_id"), 5, 0), lowered, fanout)
    return Counter(tuple(r[c] for c in COLUMNS) for r in got.collect())


def some(n, sources, seed=1):
    rng = random.Random(seed)
    texts = ["A Text", "é Ü", "", None, "lower", "x" * 3000, "Two\nLines"]
    return [
        (i, rng.choice(texts), rng.choice(["en", None]), rng.choice(sources), rng.choice([5, None, 0]))
        for i in range(n)
    ]


@pytest.mark.parametrize(("n", "fanout"), [(40, 16), (300, 16), (90, 2), (700, 3), (1, 16), (17, 16)])
def test_against_plain_trees(spark, n, fanout):
    rows = some(n, ["a", "b", "B", "é", "", None, "-", "=", "a", "a", "a"])
    assert made(spark, rows, fanout) == plain(rows, fanout)


def test_many_sources_of_one_document(spark):
    rows = some(1, ["x"]) + [(i, f"T {i}", "en", f"s{i}", i) for i in range(300)]
    got = made(spark, rows)
    assert got == plain(rows)
    assert {r[-1] for r in got} == {True, False}


def test_repeated_rows_ties_and_null_numbers(spark):
    rows = [(7, "Same", "en", "a", 4)] * 5 + [(7, "Other", "en", "a", 5), (None, "Null", "en", "a", 4)]
    rows += [(None, None, None, None, None)] * 2 + some(30, ["a", None])
    assert made(spark, rows) == plain(rows)


def test_no_rows(spark):
    docs = spark.createDataFrame([], DOCUMENTS)
    assert merkle.manifest(docs).columns == list(COLUMNS)
    assert merkle.manifest(docs).count() == 0


def test_untampered_rows_are_verified(spark):
    docs = spark.createDataFrame(some(50, ["a", "b"]), DOCUMENTS)
    assert all(r["verified"] for r in merkle.manifest(docs).collect())


def test_no_window_and_no_python_over_the_leaves(spark):
    docs = spark.createDataFrame(some(50, ["a", "b"]), DOCUMENTS)
    plan = merkle.manifest(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Window", "Cartesian", "NestedLoop"))
