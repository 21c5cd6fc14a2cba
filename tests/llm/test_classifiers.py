"""Held-out accuracy, calibration and difficult cases of the two classifiers."""

import random

import numpy as np
import pytest
from zlib import crc32

from lakestrata.llm import quality, toxicity
from lakestrata.llm.calibration import isotonic_points

from .helpers import documents, rows_of

RNG = random.Random(17)
SYLLABLES = ["an", "er", "th", "ing", "on", "re", "est", "ly", "ou"]


def prose(n):
    words = [
        RNG.choice(["the", "of", "and", "is", "that"])
        if RNG.random() < 0.3
        else "".join(RNG.choices(SYLLABLES, k=RNG.randrange(1, 4)))
        for _ in range(n)
    ]
    return " ".join(words).capitalize() + "."


def junk(n):
    kind = RNG.randrange(3)
    if kind == 0:
        return " | ".join(RNG.choice(SYLLABLES) for _ in range(n))
    if kind == 1:
        return " ".join(w + "%%%" for w in prose(n).split())
    return ("Same " * n).strip()


def labelled(spark, good, bad, n=900):
    texts = [(i, (good if i % 3 else bad)(RNG.randrange(30, 120))) for i in range(n)]
    docs = documents(spark, texts).repartition(4)
    labels = [(i, int(i % 3 > 0), int(i % 3 == 0)) for i in range(n)]
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def insult(n):
    words = prose(n).split()
    for _ in range(4):
        words.insert(RNG.randrange(len(words)), RNG.choice(["idiot", "bolwexan", "bolwexing"]))
    return "You " + " ".join(words)


ODD = [(5000, None), (5001, ""), (5002, "x" * 200_000), (None, "No number."), (5003, "word " * 60_000)]


def check(result, held, truth):
    assert result.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = rows_of(result)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    for r in rows:
        assert r["held_out"] == held(r["doc_id"])
    known = [r for r in rows if r["held_out"] and r["doc_id"] < 5000]
    assert len(known) > 100
    assert np.mean([r["predicted"] == truth(r["doc_id"]) for r in known]) > 0.95
    assert {r["doc_id"] for r in rows} >= {d for d, _ in ODD}


def test_quality(spark):
    docs, labels = labelled(spark, prose, junk)
    more = docs.union(documents(spark, ODD)).selectExpr("*", "1 AS score", "2 AS label", "3 AS statistics")
    labels = labels.selectExpr("*", "'x' AS text").union(spark.sql("SELECT 7000L, 1, 1, 'x'"))
    labels = labels.union(spark.sql("SELECT 1L, CAST(null AS INT), 1, 'x'"))
    check(
        quality.score(more, labels),
        lambda d: d is not None and crc32(str(d).encode()) % 4 == 2,
        lambda d: int(d % 3 > 0),
    )
    kept = quality.keep_good(more, labels)
    assert kept.columns == more.columns
    assert 0.6 < kept.filter("doc_id < 5000").count() / 900 < 0.7


def test_toxicity(spark):
    docs, labels = labelled(spark, prose, insult)
    more = docs.union(documents(spark, ODD)).selectExpr("*", "1 AS score", "2 AS label", "3 AS raw")
    labels = labels.selectExpr("*", "'x' AS text")
    check(
        toxicity.score(more, labels),
        lambda d: d is not None and crc32(str(d).encode()) % 3 == 1,
        lambda d: int(d % 3 == 0),
    )
    model = toxicity.train(more, labels, sample_rows=300)
    assert any(e.startswith("bolw") for e in model.lexicons.learned)


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_no_labels_and_one_label(spark, module, label):
    docs = documents(spark, [(i, prose(20)) for i in range(12)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in rows_of(module.score(docs, none))} == {0.5}
    one = spark.createDataFrame([(i, 1, 1) for i in range(12)], none.schema)
    assert {r["score"] for r in rows_of(module.score(docs, one))} == {1.0}
    assert module.score(docs.limit(0), one).count() == 0


def test_normal_equations_are_sums_over_partitions(spark):
    p = len(quality.STATISTICS)
    rows = [([float(RNG.random()) for _ in range(p)], float(i % 2)) for i in range(50)]
    frame = spark.createDataFrame(rows, "statistics array<double>, label double").repartition(7)
    rng = np.random.default_rng(1)
    model = quality.QualityModel(np.zeros(p), np.ones(p), rng.normal(size=(p, 6)), np.zeros(6), np.zeros(7), [], [])
    gram, right, n = quality.normal_equations(frame, model)
    z = model.cosines(np.array([r[0] for r in rows]))
    assert n == 50
    assert np.allclose(gram, z.T @ z) and np.allclose(right, z.T @ np.array([r[1] for r in rows]))


def test_cosines_approximate_a_gaussian_kernel():
    p = len(quality.STATISTICS)
    rng = np.random.default_rng(2)
    width, m = 0.35, 20_000
    model = quality.QualityModel(np.zeros(p), np.ones(p), rng.normal(size=(p, m)) * width, rng.uniform(0, 2 * np.pi, m), np.zeros(m + 1), [], [])
    rows = rng.normal(size=(6, p))
    z = model.cosines(rows)[:, :-1]
    exact = np.exp(-(width**2) * ((rows[:, None] - rows[None]) ** 2).sum(axis=2) / 2)
    assert np.abs(z @ z.T - exact).max() < 0.05


def test_calibration_rises(spark):
    rows = [(i / 1000, float(RNG.random() < (i / 1000) ** 2)) for i in range(1000)]
    at, share = isotonic_points(spark.createDataFrame(rows, "score double, label double"))
    assert share == sorted(share) and at == sorted(at)
    assert abs(np.interp(0.5, at, share) - 0.25) < 0.12
    assert isotonic_points(spark.createDataFrame([], "score double, label double")) == ([0.0, 1.0], [0.0, 1.0])
    model = toxicity.ToxicityModel(toxicity.Lexicons({}), None, 0.0, at, share)
    from pyspark.sql import functions as F

    tried = spark.createDataFrame([(x / 97,) for x in range(-5, 110)], "raw double")
    for r in tried.select("raw", model.calibrated(F.col("raw")).alias("c")).collect():
        assert abs(r["c"] - np.interp(r["raw"], at, share)) < 1e-9


def test_obfuscated_insults_count():
    features = toxicity.Lexicons({}).features(["what an 1d1ot and m0ron you st*pid i.d.i.o.t id1ot"])[0]
    named = dict(zip(toxicity.FEATURES, features, strict=True))
    assert named["obfuscated_words"] > 0 and named["obfuscated_insults"] > 0


def test_commonest_word_is_that_of_the_whole_text():
    at = quality.STATISTICS.index("top_word")
    words = [f"w{i}" for i in range(800)]
    assert quality.statistics(" ".join(words))[at] == 1 / 800
    stuffed = [*words[:300], *["Buy", "buy"] * 100, *words[300:]]
    assert quality.statistics(" ".join(stuffed))[at] == 200 / 1000
    assert quality.statistics("")[at] == 0


def test_every_marking_entry_is_learned(spark):
    """More marking words than any cap there was, next to harmless words that are far more frequent."""
    marking = [f"zz{i:05d}" for i in range(2500)]
    harmless = [f"hh{i:05d}" for i in range(500)]
    rows = [(" ".join([f"no{d}", *marking, *harmless]), 1.0) for d in range(9)]
    rows += [(" ".join([f"yes{d}", *harmless]), 0.0) for d in range(40)]
    rows += [rows[0], rows[-1]]
    learned = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label double")).learned
    assert set(marking) <= set(learned)
    assert not any(e.startswith("hh") or e.startswith("no") or e.startswith("yes") for e in learned)
    want = np.log(1 / (0.5 / 41))
    assert all(abs(learned[w] - want) < 1e-9 for w in marking)
