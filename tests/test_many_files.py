"""Writes of very many small files: no files beside them, moved by the tasks that write them."""

from pathlib import Path

from pyspark.sql import functions as F

from lakestrata import operators as op
from lakestrata import sinks
from lakestrata.session import many_files, work_dir


def land(spark, **options):
    path = work_dir(spark, "many")
    docs = spark.range(0, 1_050, 1, 3).select("id", F.to_json(F.struct("id")).alias("payload"))
    sinks.land_chunks(docs.transform(op.with_schema_key), path, **options)
    return Path(path.removeprefix("file:")), docs


def test_lines_land_without_checksum_files(spark):
    path, docs = land(spark)
    (folder,) = path.glob("schema_id=*")
    found = list(folder.iterdir())
    assert len(found) == 11 and not [f for f in found if f.name.endswith(".crc")]
    assert spark.read.text(str(folder)).exceptAll(docs.select("payload")).count() == 0
    assert spark.read.text(str(folder)).count() == 1_050


def test_arrays_land_without_checksum_files(spark):
    path, _ = land(spark, order_by="id")
    chunks = list(path.glob("schema_id=*/chunk=*"))
    assert len(chunks) == 11 and all(len(list(c.iterdir())) == 1 for c in chunks)


def test_a_file_system_that_the_session_names_stays(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    assert "fs.file.impl" in many_files(spark)
    conf.set("fs.file.impl", "org.apache.hadoop.fs.LocalFileSystem")
    try:
        assert "fs.file.impl" not in many_files(spark)
    finally:
        conf.unset("fs.file.impl")
