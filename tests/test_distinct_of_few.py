"""Titles with few copies, many or none: each row once, and no shuffle of all rows where none has a copy."""

import pytest
from pyspark.sql import functions as F

from lakestrata import operators as op
from lakestrata import plans

TITLES = "imdb_id string, runtime string, genre string"
BATCH = "imdb_id string, company_name string, company_origin_country string, production_country_name string"


@pytest.mark.parametrize("few", [0, 1, 200_000])
def test_each_row_once(spark, monkeypatch, few):
    monkeypatch.setattr("lakestrata.operators.merge._FEW_HASHES", few)
    rows = [("a", "1", None), ("a", None, "1"), ("b", "1", "x"), ("b", "1", "x"), (None, None, None)] * 2
    rows += [("c", "1", "x"), ("c", "1", "y"), ("", None, None)]
    df = spark.createDataFrame(rows, TITLES).repartition(3)
    got = df.transform(op.distinct_of_few)
    assert got.columns == df.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, set(rows and df.collect())))


def test_rows_with_equal_hashes_are_compared(spark, monkeypatch):
    monkeypatch.setattr("lakestrata.operators.merge.F.xxhash64", lambda *columns: F.lit(7))
    df = spark.createDataFrame([("a", "1", "x"), ("b", "1", "x"), ("a", "1", "x")], TITLES)
    assert sorted(r.imdb_id for r in df.transform(op.distinct_of_few).collect()) == ["a", "b"]


def test_titles_and_companies_are_shuffled_once(spark):
    local = spark.range(2_000).select(
        F.concat(F.lit("t"), "id").alias("imdb_id"), F.lit("90").alias("runtime"), F.lit("x").alias("genre")
    )
    batch = spark.range(2_000).select(
        F.concat(F.lit("t"), "id").alias("imdb_id"),
        F.concat(F.lit("c"), F.col("id") % 7).alias("company_name"),
        F.lit("US").alias("company_origin_country"),
        F.lit("BR").alias("production_country_name"),
    )
    df = plans.unified_movies_rows(local, [batch])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(company_name" not in plan
    assert "HashAggregate" not in plan and "BroadcastHashJoin" in plan
    assert df.count() == 2_000
