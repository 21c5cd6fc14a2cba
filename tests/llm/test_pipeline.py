"""The pipeline, stage by stage, on the smallest tables."""

import corpus_pipeline as pipeline
import public_tokenizers
from tokenizers import Tokenizer

from lakestrata.session import stage

from .helpers import documents, rows_of
from .test_near_dedup import brute
from .test_search import brute_leaks

SF_DIR = "/root/testdata/sf0.001"


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in rows_of(df)]


def test_each_stage_decides_on_its_input(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    steps = [docs]
    for name, function in pipeline.STAGES:
        out = stage(function(spark, steps[-1], SF_DIR))
        if name != "best-fit packing":
            assert out.schema == docs.schema
        steps.append(out)
    _, good, lines, near, clean, packed = steps
    assert 0.7 * docs.count() < good.count() < docs.count()
    labels = dict((r.doc_id, r.quality) for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect())
    kept = {d for d, _ in pairs(good)}
    right = [(d in kept) == bool(q) for d, q in labels.items()]
    assert sum(right) / len(right) > 0.9
    assert all(r["n_chars"] == len(r["text"]) for r in rows_of(lines))
    assert sum(len(t) for _, t in pairs(lines)) < sum(len(t) for _, t in pairs(good))
    groups = brute(pairs(lines), 5, 80, 100)
    stay = sorted(d for d, n, _, first in groups if first or not n)
    assert sorted(d for d, _ in pairs(near)) == stay
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    leaked = {d for d, *_ in brute_leaks(pairs(near), items, 5, 0.8)}
    assert sorted(d for d, _ in pairs(clean)) == sorted(d for d, _ in pairs(near) if d not in leaked)
    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    held = {}
    for r in rows_of(packed):
        held[r["doc_id"]] = held.get(r["doc_id"], 0) + r["length"]
    assert held == {d: len(plain.encode(t, add_special_tokens=False).ids) + 1 for d, t in pairs(clean)}


def test_stages_bear_difficult_rows(spark):
    long = "Some words that are as plain as any text of this kind can be. " * 20
    rows = [(1, None), (2, ""), (None, long), (3, long), (3, long), (4, "x" * 50_000), (5, "a b"), (5, "c d e f g h")]
    docs = documents(spark, rows).selectExpr("*", "1 AS kept", "2 AS score", "3 AS row")
    for frame in (docs, docs.limit(0)):
        for name, function in pipeline.STAGES:
            out = function(spark, frame, SF_DIR)
            if name != "best-fit packing":
                assert out.columns == docs.columns
            assert out.count() <= len(rows) * 13


def test_one_of_repeated_rows_stays(spark):
    text = "one two three four five six seven"
    docs = documents(spark, [(3, text), (3, text), (4, text), (3, "another text of a few words here")])
    got = dict(pipeline.STAGES)["near-dedup"](spark, docs, SF_DIR)
    assert sorted(pairs(got)) == [(3, "another text of a few words here"), (3, text)]
