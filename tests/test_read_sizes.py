"""Distinct sets are made in tasks whose input is bounded, however large the files are."""

import pytest
from pyspark.sql import functions as F

from lakestrata import operators as op
from lakestrata import plans, schemas, sinks
from lakestrata.session import tune_reads, work_dir

MOST, LEAST = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


@pytest.fixture
def sizes(spark):
    before = {name: spark.conf.get(name) for name in (MOST, LEAST)}
    yield spark
    for name, value in before.items():
        spark.conf.set(name, value)


def test_refined_plans_read_in_small_tasks(sizes):
    sizes.conf.set(MOST, "128MB")
    sizes.conf.set(LEAST, "4MB")
    titles = sizes.createDataFrame([], schemas.TRUSTED_LOCAL_KEYS)
    batch = sizes.createDataFrame([], schemas.TRUSTED_DOCUMENT_KEYS)
    assert plans.unified_movies_rows(titles, [batch]).count() == 0
    # 32 small files still go to a task.
    assert (sizes.conf.get(MOST), sizes.conf.get(LEAST)) == (f"{8 << 20}b", f"{1 << 18}b")


def test_smaller_sizes_stay(sizes):
    sizes.conf.set(MOST, "1m")
    sizes.conf.set(LEAST, "4096")
    tune_reads(sizes)
    assert (sizes.conf.get(MOST), sizes.conf.get(LEAST)) == ("1m", "4096")


def test_landed_files_are_read_by_few_tasks(sizes):
    sizes.conf.set(MOST, "128MB")
    sizes.conf.set(LEAST, "4MB")
    landed, target = work_dir(sizes, "landed"), work_dir(sizes, "target")
    docs = sizes.range(0, 20_000, 1, 8).select("id", F.format_string('{"a":%d}', "id").alias("payload"))
    sinks.land_chunks(docs.transform(op.with_schema_key), landed)
    files = sizes.read.text(landed)
    before = files.rdd.getNumPartitions()
    sinks.compact_documents(sizes, landed, target)
    assert before >= 8 and sizes.conf.get(LEAST) == f"{1 << 20}b"
    # 200 files for 8 cores: Spark still deals them to all.
    assert sizes.read.text(landed).rdd.getNumPartitions() == 8
    sizes.conf.set(LEAST, "4096")
    sinks.compact_documents(sizes, landed, target)
    assert sizes.conf.get(LEAST) == "4096"
    assert sizes.read.text(target).count() == 20_000
