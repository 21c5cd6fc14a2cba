"""Hard negatives against all pairs, and packed products against plain integers."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestrata.llm import hard_negatives as hn

VECTORS = "vec_id long, label int, embedding array<float>"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
LONGEST = 2**63


def whole(vector):
    """The integers of a vector, or None if it takes no part."""
    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(256 * float(np.float32(x))) for x in vector]


def brute(rows, every=10, k=5, share=(80, 100)):
    held = [(i, label, whole(v)) for i, label, v in rows]
    held = [r for r in held if None not in r]

    def score(a, b):
        return max(-LONGEST, min(LONGEST - 1, sum(x * y for x, y in zip(a, b))))

    out = Counter()
    for anchor, label, vector in held:
        if anchor % every:
            continue
        scored = [(-score(vector, v), i, other) for i, other, v in held]
        same = sorted((s, i) for s, i, other in scored if other == label and i != anchor)[:k]
        for p, (best, positive) in enumerate(same):
            far = sorted(
                (s, i) for s, i, other in scored
                if other != label and share[0] * -best <= share[1] * -s and s >= best
            )[:k]
            for rank, (s, i) in enumerate(far, 1):
                out[anchor, positive, rank, i, -best, -s] += 1
    return out


def mined(spark, rows, **more):
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    got = hn.hard_negatives(df, F.col("vec_id") % 10 == 0, **more).select(*COLUMNS).collect()
    return Counter(map(tuple, got))


def some(rng, n, dims, labels=3):
    return [
        (i, rng.randrange(labels), [rng.choice([-1, 1, 0.5, 0.25, 2]) * rng.random() for _ in range(dims)])
        for i in range(n)
    ]


@pytest.mark.parametrize("dims", [1, 3, 8, 40])
def test_all_pairs(spark, dims):
    rows = some(random.Random(dims), 160, dims)
    assert mined(spark, rows) == brute(rows) != Counter()


def test_small_groups_and_other_shares(spark):
    rows = some(random.Random(5), 200, 6, labels=2)
    got = mined(spark, rows, group_values=48, positives=3, negatives=3, share=(50, 100))
    assert got == brute(rows, k=3, share=(50, 100))


def test_difficult_rows(spark):
    rng = random.Random(1)
    rows = some(rng, 60, 4)
    same = [0.5, 0.5, 0.25, 1.0]
    # One vector fills most rows, with ties in every list; numbers and rows repeat.
    rows += [(i, i % 3, same) for i in range(100, 300)]
    rows += [(110, 1, same), (110, 1, same), (110, 2, [1.0, 2.0, 3.0, 4.0]), (20, 0, [0.0, 0.0, 0.0, 0.0])]
    rows += [(110, 2, same)] * 7
    rows += [(None, 1, same), (400, None, same), (410, 1, None), (420, 1, [1.0, None, 1.0, 1.0])]
    rows += [(430, 1, [1.0, float("nan"), 0.0, 0.0]), (440, 1, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(450, 1, []), (460, 2, [1.0]), (470, 1, [1.0] * 9), (-10, 1, [0.3, -0.3, 0.1, 0.9])]
    assert mined(spark, rows) == brute(rows)


def test_large_components_are_exact(spark):
    rng = random.Random(2)
    rows = [(i, i % 2, [rng.choice([1, -1]) * 2.0 ** rng.randrange(0, 18) for _ in range(5)]) for i in range(60)]
    assert mined(spark, rows) == brute(rows) != Counter()
    rows += [(i, i % 2, [rng.choice([1, -1]) * 2.0 ** rng.randrange(0, 100) for _ in range(5)]) for i in range(60, 120)]
    assert mined(spark, rows) == brute(rows) != Counter()


def test_no_rows_no_anchors_and_clashing_columns(spark):
    rows = some(random.Random(3), 30, 3)
    df = spark.createDataFrame(rows, VECTORS)
    extra = df.selectExpr("*", "1 AS anchor", "2 AS place", "3 AS vector", "4 AS positives", "5 AS `group`")
    got = hn.hard_negatives(extra, F.col("vec_id") % 10 == 0).select(*COLUMNS).collect()
    assert Counter(map(tuple, got)) == brute(rows)
    assert hn.hard_negatives(df, F.lit(False)).count() == 0
    assert hn.hard_negatives(df, F.lit(None).cast("boolean")).count() == 0
    assert hn.hard_negatives(df.limit(0), F.lit(True)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_packed_products(data):
    dims = data.draw(st.integers(0, 5))
    size = data.draw(st.sampled_from([1, 100, 10**6, 10**12]))
    number = st.integers(-size, size)
    left = data.draw(st.lists(st.lists(number, min_size=dims, max_size=dims), min_size=1, max_size=4))
    right = data.draw(st.lists(st.lists(number, min_size=dims, max_size=dims), min_size=1, max_size=9))
    right_matrix = np.array(right, dtype=np.float64).reshape(len(right), dims)
    chunk = hn.Candidates(np.arange(len(right)), right_matrix)
    for _ in range(2):
        got = chunk.scores(hn.Side(np.array(left, dtype=np.float64).reshape(len(left), dims)))
        want = [[sum(x * y for x, y in zip(a, b)) for b in right] for a in left]
        want = [[max(-LONGEST, min(LONGEST - 1, s)) for s in row] for row in want]
        assert got.tolist() == want


def test_several_candidates_share_a_multiplication():
    values = np.random.default_rng(0).integers(-130, 130, (1000, 64)).astype(float)
    chunk = hn.Candidates(np.arange(1000), values)
    chunk.scores(hn.Side(values[:3]))
    (words,) = chunk.words.values()
    assert words.shape == (64, 500)


def test_matrix_pads_and_cuts():
    vectors = pa.array([[9.0], [0.5, -0.001], [], [1, 1, 1]], pa.list_(pa.float32()))
    assert hn.matrix(vectors.slice(1), 2).tolist() == [[128, -1], [0, 0], [256, 256]]
    assert hn.matrix(vectors).shape == (4, 3)
