"""What a staged write leaves on the disks."""

from pyspark.sql import functions as F

from lakestrata import session


def shuffles(spark, df) -> set[int]:
    """The shuffles of a staged write whose files the cluster still knows when it has ended."""
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    first = spark.sparkContext._jsc.sc().newShuffleId()
    session.stage(df)
    last = spark.sparkContext._jsc.sc().newShuffleId()
    assert last > first + 1, "nothing was shuffled"
    return {i for i in range(first + 1, last) if tracker.containsShuffle(i)}


def test_the_shuffles_of_a_staged_write_go_when_it_ends(spark):
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n"))
    assert shuffles(spark, rows) == set()


def test_staging_keeps_rows_and_the_setting(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    rows = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).agg(F.count("*").alias("n"))
    once = session.stage(rows)
    again = session.stage(rows.join(once.select("k"), "k"))
    assert sorted(again.collect()) == sorted(rows.collect()) == [(k, 100) for k in range(10)]
    assert spark.conf.get(name, None) == before
