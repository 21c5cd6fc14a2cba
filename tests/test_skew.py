"""A third of all rows on one key: the plans must cut it up and keep every row."""

import pytest
from pyspark.sql import functions as F

from lakestrata import operators as op
from lakestrata import plans, sinks
from lakestrata.session import tune, work_dir

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.files.maxPartitionBytes": "64k",
    "spark.sql.files.openCostInBytes": "1k",
}


@pytest.fixture
def small_sizes(spark):
    """Sizes at which a few thousand rows count as large."""
    tune(spark)
    before = {k: spark.conf.get(k) for k in SMALL}
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(name, key, rows):
    """``key`` for a third of the rows, else a value of its own."""
    return F.when(F.col("id") < rows // 3, key).otherwise(F.concat(F.lit(name), F.col("id")))


def test_hot_title_and_hot_company(spark, small_sizes):
    rows = 30_000
    text = F.sha2(F.col("id").cast("string"), 256)
    local = spark.range(0, rows, 1, 8).select(
        hot("t", "t-hot", rows).alias("imdb_id"), F.lit("90").alias("runtime"), text.alias("genre")
    )
    batch = spark.range(0, rows, 1, 8).select(
        F.concat(F.lit("t"), F.col("id") + rows // 3).alias("imdb_id"),
        hot("c", "c-hot", rows).alias("company_name"),
        F.lit("US").alias("company_origin_country"),
        F.lit("US").alias("production_country_name"),
    )
    of_hot = spark.createDataFrame([("t-hot", "c-hot", "US", "US")], batch.schema)
    got = plans.unified_movies_rows(local, [batch, of_hot])
    plan = final_plan(got)
    assert "skew=true" in plan
    assert got.filter("imdb_id = 't-hot'").count() == rows // 3
    assert got.count() == rows


def test_hot_set_of_keys_is_landed_by_many_tasks(spark, small_sizes):
    rows = 6_000
    docs = spark.range(0, rows, 1, 8).select(
        F.concat(F.lit('{"a":"'), F.sha2(F.col("id").cast("string"), 256), F.lit('"}')).alias(
            "payload"
        )
    )
    path = work_dir(spark, "hot")
    sinks.land_chunks(docs.transform(op.with_schema_key), path)
    files = spark.read.text(path).groupBy(F.col("_metadata.file_path").alias("f")).count()
    found = files.collect()
    # Spark names a file part-<task>-..: more than one task wrote the one folder.
    assert len({r.f.rsplit("/", 1)[1].split("-")[1] for r in found}) > 4
    assert sum(r["count"] for r in found) == rows and max(r["count"] for r in found) <= 100


def test_ordered_chunks_of_one_group_use_many_tasks(spark, small_sizes):
    df = spark.range(0, 20_000, 1, 8).select(
        F.lit("g").alias("g"), "id", F.sha2(F.col("id").cast("string"), 256).alias("payload")
    )
    got = op.chunk_within(df, "g", "id")
    assert got.select(F.spark_partition_id()).distinct().count() > 1
    assert got.filter("position <> id + 1 OR chunk <> id div 100 + 1").isEmpty()
    assert got.count() == 20_000
