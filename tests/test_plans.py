"""The shape of the physical plans."""

import pytest
from pyspark.sql import functions as F

from lakestrata import operators as op
from lakestrata import plans, sources
from lakestrata.schemas import MOVIE_RENAMES
from lakestrata.session import stage, tune, work_dir
from workload.inputs import SPELLINGS, document_batches, documents, local_file

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def local(spark):
    return stage(local_file(tune(spark), SF_DIR))


def test_trusted_local_pushes_the_filter_and_never_shuffles(spark, local):
    text = executed(plans.trusted_local_rows(local, MOVIE_RENAMES, "x"))
    assert "EqualTo(nomeArtista,x)" in text
    assert "titulosMaisConhecidos" not in text.split("ReadSchema")[1]
    assert "Exchange" not in text


def test_delimited_filter_is_pushed(spark):
    path = work_dir(spark, "csv")
    local_file(spark, SF_DIR).write.options(header=True, sep="|").csv(path)
    raw = sources.read_delimited(spark, path)
    text = executed(plans.trusted_local_rows(raw, MOVIE_RENAMES, "x"))
    assert "EqualTo(nomeArtista,x)" in text and "Exchange" not in text


def test_trusted_documents_never_shuffle(spark):
    docs = stage(documents(spark, SF_DIR))
    text = executed(plans.trusted_document_rows(docs, SPELLINGS))
    assert "Exchange" not in text
    assert "logo_path" not in text.split("ReadSchema")[-1]


def test_refined_table_does_not_shuffle_its_result(spark, local):
    trusted = stage(plans.trusted_local_rows(local, MOVIE_RENAMES, None))
    batches = [
        stage(plans.trusted_document_rows(b, SPELLINGS)) for b in document_batches(spark, SF_DIR)
    ]
    df = plans.unified_movies_rows(trusted, batches)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = executed(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = [line.strip(" :+-") for line in text.splitlines()]
    # From the top: project and joins only, until a sort of a join input.
    top = [line.split(" ")[0] for line in lines[1:]]
    assert top[: top.index("Sort")] == ["Project", "SortMergeJoin", "Project", "SortMergeJoin"]
    assert "SinglePartition" not in text and "collect_list" not in text
    reads = [line for line in lines if line.startswith("FileScan")]
    # The facts of all batches come from one stored table, once for each kind.
    assert len(reads) == 1 + 3
    assert not any("genre_name" in r or "overview" in r for r in reads)


def test_the_rows_of_ordered_chunks_are_shuffled_once(spark):
    rows = spark.range(3000).select(F.lit("g").alias("g"), "id")
    text = plan(op.chunk_within(rows, "g", "id"))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_keys_are_counted_before_they_are_shuffled(spark):
    keys = spark.range(0, 100, 1, 4).select((F.col("id") % 3).alias("id"))
    lines = executed(op.count_keys(keys, "id")).splitlines()
    counted = next(i for i, line in enumerate(lines) if "partial_count" in line)
    assert "Exchange hashpartitioning" in lines[counted - 1]


def test_documents_of_few_keys_are_not_shuffled(spark):
    docs = stage(spark.range(5000).withColumn("payload", F.lit("{}")))
    keys = stage(spark.range(0, 5000))
    text = plan(op.enrich_counted(keys.filter("id < 9"), docs, "id"))
    assert "BroadcastHashJoin" in text
