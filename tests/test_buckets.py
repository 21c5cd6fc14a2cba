"""Tables in buckets: published like others, read without a shuffle of the bucketed side."""

import os

import pytest
from pyspark.sql import functions as F

from lakestrata import plans, sinks, sources
from lakestrata.schemas import MOVIE_RENAMES
from lakestrata.session import stage, work_dir
from workload.inputs import SPELLINGS, document_batches, local_file

SF_DIR = "/root/testdata/sf0.001"


def rows(spark, n, **columns):
    made = [F.expr(v).alias(k) for k, v in columns.items()]
    return spark.range(0, n, 1, 3).select(F.concat(F.lit("tt"), F.col("id") % 50).alias("imdb_id"), "id", *made)


def bucket_files(spark, name):
    place = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()["data_type"]
    folder = place.removeprefix("file://").removeprefix("file:")
    return [f for f in os.listdir(folder) if f.endswith(".parquet")]


def test_versions_in_buckets(spark):
    path = work_dir(spark, "buckets")
    name = sinks.save_table(rows(spark, 300), "bucket_db", "titles", path, buckets=("imdb_id", 4))
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('k' = '1')")
    sinks.save_table(rows(spark, 200, more="'x'"), "bucket_db", "titles", path, buckets=("imdb_id", 4))
    assert spark.table(name).count() == 200 and spark.table(name).columns == ["imdb_id", "id", "more"]
    assert len(bucket_files(spark, name)) <= 4
    held = {r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert "k" in held
    tables = [r["tableName"] for r in spark.sql("SHOW TABLES IN bucket_db").collect()]
    assert tables == ["titles"]
    text = spark.table(name).groupBy("imdb_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Bucketed: true" in text
    # Other buckets, then none: the table is defined anew, with its properties.
    for buckets in (("imdb_id", 6), None):
        sinks.save_table(rows(spark, 100), "bucket_db", "titles", path, buckets=buckets)
        assert spark.table(name).count() == 100
        assert "k" in {r["key"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    with pytest.raises(ValueError):
        sinks.save_table(rows(spark, 9), "bucket_db", "titles", path, partition_by=["id"], buckets=("imdb_id", 6))


def test_a_failed_write_leaves_the_old_rows(spark):
    path = work_dir(spark, "buckets")
    name = sinks.save_table(rows(spark, 30), "bucket_db", "fails", path, buckets=("imdb_id", 4))
    broken = rows(spark, 40, v="raise_error('stop')")
    with pytest.raises(Exception, match="stop"):
        sinks.save_table(broken, "bucket_db", "fails", path, buckets=("imdb_id", 4))
    assert spark.table(name).count() == 30
    assert not [r for r in spark.sql("SHOW TABLES IN bucket_db").collect() if r["tableName"].startswith("fails_")]


def test_the_bucketed_titles_are_not_shuffled(spark):
    trusted = stage(plans.trusted_local_rows(local_file(spark, SF_DIR), MOVIE_RENAMES, None))
    name = sinks.save_table(trusted, "bucket_db", "local", work_dir(spark, "b"), buckets=("imdb_id", 8))
    batches = [stage(plans.trusted_document_rows(b, SPELLINGS)) for b in document_batches(spark, SF_DIR)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = plans.unified_movies_rows(sources.read_place(spark, name), batches)
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-"))
    above, indent = [], depth
    for line in reversed(lines[:scan]):
        here = len(line) - len(line.lstrip(" :+-"))
        if here < indent:
            above.append(line.strip(" :+-"))
            indent = here
    assert not any("Exchange" in line for line in above), above
    assert sum("SortMergeJoin" in line for line in above) == 2
    assert sources.read_place(spark, name).count() == trusted.count()


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    monkeypatch.setattr("lakestrata.sinks.catalog.BUCKET_ROWS", 50)
    name = sinks.save_table(rows(spark, 300), "bucket_db", "grown", work_dir(spark, "g"), buckets=("imdb_id", 4))
    described = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Num Buckets'")
    assert described.first()["data_type"] == "8"
    assert spark.table(name).count() == 300
