"""Ordered chunks with one shuffle of the payloads equal numbered and grouped rows."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestrata.operators import grouping


def plain(rows, size):
    """``{(group, chunk): [payload ..]}`` of rows (group, key, payload, copies)."""
    out, n = {}, {}
    for g, _, payload, copies in sorted(rows, key=lambda r: ((r[0] is not None, r[0] or ""), r[1], r[2])):
        for _ in range(copies):
            n[g] = n.get(g, 0) + 1
            out.setdefault((g, (n[g] - 1) // size + 1), []).append(payload)
    return {k: "[" + ",".join(v) + "]" for k, v in out.items()}


def made(spark, rows, size, copies, order_by="key"):
    df = spark.createDataFrame(rows, "g string, key long, payload string, copies long").repartition(3)
    got = grouping.ordered_chunks(df, "g", order_by, "payload", "copies" if copies else None, size).collect()
    assert len({(r["g"], r["chunk"]) for r in got}) == len(got)
    return {(r["g"], r["chunk"]): r["documents"] for r in got}


@pytest.fixture
def many_tasks(spark):
    """Small shuffles stay in many tasks, as large ones would be."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("copies", [False, True])
@pytest.mark.parametrize(("n", "size"), [(700, 10), (300, 100), (50, 100), (23, 7), (1, 3), (400, 1)])
def test_equals_the_plain_form(spark, many_tasks, n, size, copies):
    """Ranges begin within chunks, and chunks may reach over several ranges."""
    rng = random.Random(n * size)
    rows = [
        (rng.choice(["most", "most", "most", "few", None, ""]), i, f'{{"i":{i}}}', rng.choice([1, 1, 3, 40]) if copies else 1)
        for i in range(n)
    ]
    assert made(spark, rows, size, copies) == plain(rows, size)


def test_a_document_that_fills_most_chunks(spark, many_tasks):
    rows = [("g", i, f'{{"i":{i}}}', 2000 if i == 50 else 1) for i in range(200)]
    assert made(spark, rows, 10, True) == plain(rows, 10)


def test_ties_null_keys_and_two_keys(spark, many_tasks):
    rng = random.Random(9)
    rows = [("g" if i % 3 else "h", rng.randrange(9), f"{rng.randrange(30)}", 1) for i in range(400)]
    assert made(spark, rows, 10, False) == plain(rows, 10)
    df = spark.createDataFrame([(r[0], None if r[1] == 4 else r[1], r[2], r[3]) for r in rows], "g string, key long, payload string, copies long")
    got = grouping.ordered_chunks(df, "g", ["key", "payload"], size=10).collect()
    want = plain([(g, -1 if k == 4 else k, p, c) for g, k, p, c in rows], 10)
    assert {(r["g"], r["chunk"]): r["documents"] for r in got} == want


def test_no_rows(spark):
    assert made(spark, [], 10, False) == {}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.data())
def test_any_ranges(spark, data):
    size = data.draw(st.integers(1, 12))
    rows = [
        (data.draw(st.sampled_from(["a", "b", None])), i, str(i), data.draw(st.sampled_from([1, 1, 2, 15])))
        for i in range(data.draw(st.integers(0, 60)))
    ]
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        assert made(spark, rows, size, True) == plain(rows, size)
    finally:
        spark.conf.set(name, before)


def test_the_payloads_are_shuffled_once(spark):
    df = spark.range(5000).select(
        F.lit("g").alias("g"), "id", F.format_string('{"a":%d}', "id").alias("payload")
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = grouping.ordered_chunks(df, "g", "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 1 and "Join" not in text and "Window" in text
