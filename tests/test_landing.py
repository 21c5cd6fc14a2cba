import json
import os
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from lakestrata import operators as op
from lakestrata import plans, schemas, sinks, sources
from lakestrata.schemas import LONG, STRING, struct
from lakestrata.session import stage, work_dir

PAIR = struct(id=STRING, name=STRING)


def grouped_documents(spark):
    """165 documents with keys a and b, 165 with a."""
    numbers = spark.range(330)
    text = F.when(
        F.col("id") < 165, F.format_string('{"a":%d,"b":1}', "id")
    ).otherwise(F.format_string('{"a":%d}', "id"))
    return numbers.select("id", text.alias("payload")).transform(op.with_schema_key)


def files_below(path, suffix):
    return [
        os.path.join(root, f)
        for root, _, names in os.walk(path.removeprefix("file:"))
        for f in names
        if f.endswith(suffix)
    ]


def test_lines_are_bounded_per_file_and_complete(spark):
    path = work_dir(spark, "lines")
    for _ in range(2):
        sinks.land_chunks(grouped_documents(spark), path)
    sizes = Counter()
    for name in files_below(path, ".txt"):
        with open(name) as f:
            lines = f.read().splitlines()
        assert 0 < len(lines) <= 100
        assert len({tuple(sorted(json.loads(line))) for line in lines}) == 1
        sizes[os.path.basename(os.path.dirname(name))] += len(lines)
    assert sorted(sizes.values()) == [165, 165]


def test_numbered_arrays(spark):
    path = work_dir(spark, "arrays")
    sinks.land_chunks(grouped_documents(spark), path, order_by="id")
    found = {}
    for name in files_below(path, ".txt"):
        chunk = os.path.dirname(name)
        with open(name) as f:
            found[chunk.removeprefix(path)] = [d["a"] for d in json.load(f)]
    assert sorted(map(len, found.values())) == [65, 65, 100, 100]
    assert sorted(n for chunk in found.values() for n in chunk) == list(range(330))
    assert all(chunk == sorted(chunk) for chunk in found.values())
    assert sources.read_document_arrays(spark, path, struct(a=LONG)).count() == 330


def test_line_breaks_inside_a_document_stay_in_one_line(spark):
    path = work_dir(spark, "pretty")
    docs = spark.createDataFrame([('{\n  "a": "x\\ny"\r\n}',)], "payload string")
    sinks.land_chunks(docs.transform(op.with_schema_key), path)
    assert sources.read_document_lines(spark, path, struct(a=STRING)).collect()[0].a == "x\ny"


@pytest.mark.parametrize("order_by", [None, "id"])
def test_copies_are_written_out(spark, order_by):
    path = work_dir(spark, "copies")
    docs = spark.createDataFrame(
        [(1, '{"a":1}', 250), (2, '{"a":2}', 1), (3, '{"a":3}', 99)],
        "id long, payload string, copies long",
    ).transform(op.with_schema_key)
    sinks.land_chunks(docs, path, order_by=order_by, copies="copies")
    read = sources.read_document_arrays if order_by else sources.read_document_lines
    got = read(spark, path, struct(a=LONG)).groupBy("a").count()
    assert {r.a: r["count"] for r in got.collect()} == {1: 250, 2: 1, 3: 99}
    per_file = read(spark, path, struct(a=LONG)).groupBy(F.col("_metadata.file_path")).count()
    assert max(r["count"] for r in per_file.collect()) <= 100


@pytest.fixture
def many_tasks(spark):
    """Keep small shuffles in many tasks, as large ones would be."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_numbers_across_tasks_equal_a_window(spark, many_tasks):
    """One group holds most rows, one key is null: the range partitions cut the group."""
    df = spark.range(5000).select(
        F.col("id"),
        F.when(F.col("id") % 10 == 0, "small").when(F.col("id") % 10 < 8, "big").alias("g"),
        F.md5(F.col("id").cast("string")).alias("k"),
    )
    got = op.number_within(df, "g", "k")
    want = spark.sql(
        "SELECT *, cast(row_number() OVER (PARTITION BY g ORDER BY k) AS bigint) AS position"
        " FROM {df}", df=df,
    )
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_runs_of_copies_equal_numbered_rows(spark, many_tasks):
    """A third of all rows are copies of one document."""
    n = F.when(F.col("id") == 77, 700).otherwise(F.col("id") % 6 + 1)
    df = spark.range(400).select("id", (F.col("id") % 3).alias("g"), n.alias("copies"))
    runs = op.chunk_copies(df, "g", "id", size=10)
    assert runs.agg(F.max("copies")).first()[0] <= 10
    rows = op.repeat_copies(df).select("g", "id")
    want = spark.sql(
        "SELECT g, id, (row_number() OVER (PARTITION BY g ORDER BY id) - 1) div 10 + 1 AS chunk"
        " FROM {rows}", rows=rows,
    )
    got = op.repeat_copies(runs).select("g", "id", "chunk")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    split = op.split_copies(df, size=10)
    assert split.agg(F.max("copies")).first()[0] <= 10
    total = df.agg(F.sum("copies")).first()[0]
    assert split.agg(F.sum("copies")).first()[0] == total == got.count()


def test_long_ranges_are_written_in_blocks(spark):
    df = spark.createDataFrame([(1, 2_345_678)], "id long, copies long")
    split = op.split_copies(df, size=100)
    assert split.count() == 23_457
    assert split.agg(F.sum("copies")).first()[0] == 2_345_678


LOOKUPS = [
    ("a", 200, '{"id":"a","name":"A"}'),
    ("b", 404, '{"id":"b","name":"B"}'),
    ("c", 200, None),
    ("d", 200, "{ }"),
    ("e", None, '{"id":"e","name":"E"}'),
    ("f", 200, "[]"),
]


def test_lookups(spark):
    answers = spark.createDataFrame(LOOKUPS, "id string, status int, payload string")
    assert [r.id for r in op.found(answers).collect()] == ["a"]
    assert sorted(r.id for r in op.failed(answers).collect()) == ["b", "c", "d", "e", "f"]
    keys = spark.createDataFrame([("a",), ("a",), ("z",), (None,)], "id string")
    assert op.enrich(keys, answers, "id").count() == 2
    assert [(r.id, r.copies) for r in op.enrich_counted(keys, answers, "id").collect()] == [("a", 2)]
    unknown = [r.id for r in op.unknown_keys(keys, answers, "id").collect()]
    assert sorted(unknown, key=str) == [None, "z"]


def test_file_landing_replaces_its_day_only(spark):
    target = work_dir(spark, "raw")

    def land(day, *rows):
        source = work_dir(spark, "source")
        df = spark.createDataFrame(list(rows), PAIR)
        df.write.options(header=True, sep="|", quote='"', escape='"').csv(source)
        plans.run_landing(spark, source, target, day)

    first, second = date(2023, 11, 6), date(2023, 12, 1)
    land(first, ("1", "old"))
    land(second, ("2", "kept"))
    land(first, ("1", 'new | "quoted"'), ("3", None), ("4", ""))
    day = sources.read_landed_day(spark, target, first, PAIR)
    assert {tuple(r) for r in day.collect()} == {("1", 'new | "quoted"'), ("3", None), ("4", "")}
    landed = sources.read_landed(spark, target, PAIR)
    assert {(r.year, r.month, r.day) for r in landed.collect()} == {
        ("2023", "11", "06"), ("2023", "12", "01")
    }
    assert landed.count() == 4
    assert os.path.isdir(f"{target}/year=2023/month=11/day=06")
    plan = landed.filter("day = '06'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_rows_landed_by_their_own_day_replace_only_those_days(spark):
    target = work_dir(spark, "dated")
    rows = spark.createDataFrame(
        [("1", "2024-01-02 10:00:00"), ("2", "2024-02-03 00:00:00")], "id string, at string"
    ).withColumn("at", F.col("at").cast("timestamp_ntz"))
    sinks.land_by_date(rows, target, F.col("at"), "parquet")
    sinks.land_by_date(rows.filter("id = '1'"), target, F.col("at"), "parquet")
    assert spark.read.parquet(target).count() == 2


def test_header_must_match_the_contract(spark):
    path = work_dir(spark, "header")
    spark.createDataFrame([("1", "x")], PAIR).write.options(header=True, sep="|").csv(path)
    assert sources.read_delimited(spark, path, PAIR).count() == 1
    by_name = sources.read_delimited(spark, path, contract=struct(name=STRING))
    assert by_name.columns == ["id", "name"]
    with pytest.raises(schemas.ContractError):
        sources.read_delimited(spark, path, contract=struct(other=STRING))
    with pytest.raises(Exception, match="(?i)header"):
        sources.read_delimited(spark, path, struct(id=STRING, other=STRING)).collect()


def test_plain_dated_directories(spark):
    base = work_dir(spark, "plain")
    df = spark.createDataFrame([("1", "x")], PAIR)
    df.write.options(header=True, sep="|").csv(f"{base}/2023/11/06")
    row = sources.read_delimited(spark, base, PAIR, dated_directories=True).first()
    assert (row.id, row.year, row.month, row.day) == ("1", "2023", "11", "06")


def test_enrichment_lands_every_hit(spark):
    schema = struct(id=STRING, nomeArtista=STRING)
    raw, target = work_dir(spark, "raw"), work_dir(spark, "docs")
    day = date(2023, 11, 6)
    local = [("a", "x"), ("a", "x"), ("b", "x"), ("a", "other")]
    sinks.land_by_date(spark.createDataFrame(local, schema), raw, day)
    answers = spark.createDataFrame(LOOKUPS, "id string, status int, payload string")
    for _ in range(2):
        path = plans.run_enrichment(
            spark, raw, answers, target, "x", date(2023, 11, 7), landed_on=day
        )
    assert path.endswith("year=2023/month=11/day=07")
    got = sources.read_document_lines(spark, path, PAIR)
    assert [r.id for r in got.collect()] == ["a", "a"]


def test_saved_table_is_replaced_with_its_columns(spark):
    path = work_dir(spark, "table")
    one = spark.createDataFrame([(1, "a")], "id int, x string")
    two = spark.createDataFrame([(2, 3)], "id int, y int")
    name = sinks.save_table(one, schemas.REFINED_DATABASE, "replaced", path)
    assert sinks.save_table(two, schemas.REFINED_DATABASE, "replaced", path, rebalance=True) == name
    got = sources.read_table(spark, name, two.schema)
    assert got.columns == ["id", "y"] and got.count() == 1
    assert spark.read.parquet(path).count() == 1


def test_saved_files_are_bounded(spark):
    path = work_dir(spark, "bounded")
    sinks.save_table(
        spark.range(250), schemas.REFINED_DATABASE, "bounded", path, max_records_per_file=20
    )
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count()
    assert max(r["count"] for r in files.collect()) <= 20


def test_stage_keeps_rows_and_schema(spark):
    df = spark.range(10).withColumn("x", F.array(F.lit("a")))
    got = stage(df)
    assert got.count() == 10 and got.columns == df.columns


def test_work_dir_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_dir(Session(), "x")
