"""Files of a given size, whatever a row takes."""

import pytest
from pyspark.sql import functions as F

from lakestrata import sinks
from lakestrata.session import work_dir


def sizes(spark, name):
    files = spark.table(name).groupBy("_metadata.file_path").agg(F.max("_metadata.file_size").alias("s"))
    return [r["s"] for r in files.collect()]


@pytest.mark.parametrize(("n", "width"), [(20_000, 4), (2_000, 300), (60_000, 20)])
def test_sizes_lie_in_a_band(spark, n, width):
    text = F.substring(F.repeat(F.sha2(F.col("id").cast("string"), 256), 5), 1, width)
    df = spark.range(0, n, 1, 11).select("id", text.alias("t"))
    path = work_dir(spark, "sized")
    name = sinks.save_table(df, "sized_db", f"t{width}", path, file_bytes=100_000)
    found = sizes(spark, name)
    assert len(found) > 1 and all(50_000 < s < 200_000 for s in found)
    assert spark.table(name).count() == n


def test_one_small_file_partitions_and_no_rows(spark):
    path = work_dir(spark, "sized")
    name = sinks.save_table(spark.range(10), "sized_db", "small", path, file_bytes=1 << 20)
    assert len(sizes(spark, name)) == 1
    sinks.save_table(spark.range(0), "sized_db", "small", path, file_bytes=1 << 20)
    assert spark.table(name).count() == 0
    df = spark.range(0, 30_000, 1, 6).select(
        F.sha2(F.col("id").cast("string"), 256).alias("t"), F.when(F.col("id") % 10 < 7, "hot").otherwise("cold").alias("p")
    )
    name = sinks.save_table(df, "sized_db", "parts", work_dir(spark, "sized"), partition_by=["p"], file_bytes=200_000)
    assert spark.table(name).count() == 30_000
    assert max(sizes(spark, name)) < 400_000
