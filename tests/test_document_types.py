"""Types of fields are found while documents land, and read with no further look at them."""

import itertools
import json
from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from lakestrata import plans, schemas, sinks, sources
from lakestrata.functions import document_types as dt
from lakestrata.layout import day_path
from lakestrata.operators import with_schema_key
from lakestrata.plans import trusted
from lakestrata.session import work_dir

LISTS = {
    "genres": [{"id": 1, "name": "g"}],
    "production_companies": [{"name": "c"}],
    "production_countries": [{"name": "n"}],
    "spoken_languages": [{"name": "l"}],
}


def payloads(spark, documents):
    texts = [d if isinstance(d, str) or d is None else json.dumps(d) for d in documents]
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "n int, payload string").repartition(3).transform(with_schema_key)


def land(spark, documents, **more):
    path = work_dir(spark, "typed")
    sinks.land_chunks(payloads(spark, documents), path, **more)
    return path


def whole(**fields):
    return {"imdb_id": "tt1", **LISTS, **fields}


def rows_by_name(spark, path, table, *columns, **more):
    name = plans.run_documents(spark, path, work_dir(spark, "trusted"), table, **more)
    found = spark.table(name)
    return found, sorted(map(tuple, found.select(*columns).collect()), key=repr)


def test_undeclared_fields_get_their_types(spark):
    docs = [
        whole(n=1, part=1, flag=True, odd="x", at={"a": 1, "b": [1]}, list=[{"x": 1}], none=None, empty={}, huge=10**25, f=1.0),
        whole(n=2**63 - 1, part=2.5, flag=False, odd=3, at={"a": None, "c": "z"}, list=[{"y": "q"}, {}], none=None, empty={}, huge=1, f=2.0),
        whole(n=None, part=None, flag=None, odd=[1], at=None, list=[], none=None, empty=None, huge=None, f=None),
    ]
    path = land(spark, docs)
    table, rows = rows_by_name(spark, path, "typed", "n", "part", "flag", "odd", "none", "empty", "huge", "f")
    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    assert kinds["n"] == "bigint" and kinds["part"] == "double" and kinds["flag"] == "boolean"
    assert kinds["odd"] == kinds["none"] == kinds["empty"] == "string"
    assert kinds["huge"] == "decimal(38,0)" and kinds["f"] == "double"
    assert kinds["at"] == "struct<a:bigint,b:array<bigint>,c:string>"
    assert kinds["list"] == "array<struct<x:bigint,y:string>>"
    assert rows == sorted(
        [
            (1, 1.0, True, "x", None, "{}", 10**25, 1.0),
            (2**63 - 1, 2.5, False, "3", None, "{}", 1, 2.0),
            (None, None, None, "[1]", None, None, None, None),
        ],
        key=repr,
    )


def test_documents_are_read_once(spark, monkeypatch):
    path = land(spark, [whole(n=1), whole(m="x")])
    saved = []
    monkeypatch.setattr(trusted, "document_fields", lambda *_: pytest.fail("read once more"))
    monkeypatch.setattr(trusted, "save_table", lambda df, *_, **__: saved.append(df) or "")
    plans.run_documents(spark, path, "nowhere", "none")
    plan = saved[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    assert {"n", "m"} <= set(saved[0].columns) and saved[0].count() == 2


@pytest.mark.parametrize("order_by", [None, "n"])
def test_names_that_differ_only_in_case(spark, order_by):
    docs = [whole(budget=1, Genres="text", genre_name="kept", inner={"a": 1, "A": 2}), whole(Budget="b", BUDGET=[1], inner=None)]
    path = land(spark, docs, order_by=order_by)
    table, rows = rows_by_name(
        spark, path, f"cased_{order_by}", "BUDGET", "Budget_2", "budget_3", "Genres_2", "genre_name_2", "inner",
        "genre_name", arrays=order_by is not None,
    )
    assert rows == [(None, None, 1, "text", "kept", '{"a":1,"A":2}', "g"), ([1], "b", None, None, None, None, "g")]
    assert len({c.lower() for c in table.columns}) == len(table.columns)


def test_case_without_a_kept_schema(spark):
    path = work_dir(spark, "text")
    lines = [json.dumps(whole(budget=1, Budget="x"))]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    _, rows = rows_by_name(spark, path, "cased_text", "Budget", "budget_2")
    assert rows == [("x", "1")]
    aside = work_dir(spark, "aside")
    _, rows = rows_by_name(spark, path, "cased_aside", "Budget", "budget_2", quarantine=aside)
    assert rows == [("x", "1")] and spark.read.parquet(aside).count() == 0


def test_documents_no_variant_can_hold(spark):
    twice = '{"imdb_id":"tt1","a":1,"a":"x",' + json.dumps(LISTS)[1:]
    path = land(spark, [twice, whole(b=1)])
    table, rows = rows_by_name(spark, path, "twice", "imdb_id", "b")
    assert rows == [("tt1", "1"), ("tt1", None)] or rows == [("tt1", 1), ("tt1", None)]
    assert table.schema["a"].dataType == dt.TEXT


def test_lines_that_are_no_documents(spark):
    path = land(spark, [whole(n=1), "[1]", "{broken", None, '"text"'])
    aside = work_dir(spark, "aside")
    _, rows = rows_by_name(spark, path, "no_documents", "n", quarantine=aside)
    assert rows == [(1,)]
    assert {r.value for r in spark.read.parquet(aside).collect()} == {"[1]", "{broken", '"text"'}


def test_several_landed_days_are_merged(spark):
    base = work_dir(spark, "days")
    for day, doc in ((1, whole(n=1, m=1)), (2, whole(n=0.5, o="x"))):
        sinks.land_chunks(payloads(spark, [doc]), day_path(base, date(2023, 11, day)))
    fields = sources.landed_fields(spark, base)
    assert {n: k.simpleString() for n, k in fields.items() if n in "mno"} == {"m": "bigint", "n": "double", "o": "string"}
    assert sources.landed_fields(spark, [day_path(base, date(2023, 11, 1))])["n"] == T.LongType()
    # One day was landed without: the documents have to be looked at.
    spark.createDataFrame([('{"q":1}',)], "value string").write.text(f"{base}/year=2023/month=11/day=03/schema_id=x")
    assert sources.landed_schemas(spark, base) is None
    assert sources.landed_fields(spark, work_dir(spark, "nothing")) is None


def test_one_pass_lands_and_types(spark):
    """The landing runs the documents' plan once, typing included."""
    counted = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            counted.add(batch.num_rows)
            yield batch

    rows = payloads(spark, [whole(n=i) for i in range(40)]).mapInArrow(count, "n int, payload string, schema_key string")
    path = work_dir(spark, "once")
    sinks.land_chunks(rows, path)
    assert counted.value == 40
    assert sources.landed_fields(spark, path)["n"] == T.LongType()


def test_a_rerun_replaces_what_was_kept(spark):
    path = land(spark, [whole(n=1)])
    sinks.land_chunks(payloads(spark, [whole(n="x")]), path)
    assert sources.landed_fields(spark, path)["n"] == T.StringType()


def kinds():
    leaf = st.sampled_from([dt.NULL, dt.BOOLEAN, dt.LONG, dt.WHOLE, dt.DOUBLE, dt.TEXT])

    def nested(kind):
        fields = st.dictionaries(st.sampled_from("abA"), kind, max_size=3)
        objects = fields.map(lambda d: T.StructType([T.StructField(n, d[n]) for n in sorted(d)]))
        return st.one_of(objects, kind.map(T.ArrayType))

    return st.recursive(leaf, nested, max_leaves=6)


@settings(max_examples=300, deadline=None)
@given(kinds(), kinds(), kinds())
def test_merging_is_that_of_a_lattice(a, b, c):
    assert dt.merge(a, a) == a
    assert dt.merge(a, b) == dt.merge(b, a)
    assert dt.merge(dt.merge(a, b), c) == dt.merge(a, dt.merge(b, c))
    assert dt.merge(dt.merge(a, b), b) == dt.merge(a, b)


def test_merging_in_the_aggregate_is_the_same(spark):
    values = [None, True, 1, 2.5, "x", {"a": 1}, {"a": "y", "b": None}, [1], [2.5], [], [{"c": 1}], {}]
    for a, b in itertools.combinations(values, 2):
        frame = payloads(spark, [{"v": a}, {"v": b}]).coalesce(1)
        both = frame.agg(dt.merged_types("payload", "schema_key").alias("t"))
        each = frame.groupBy("n").agg(dt.merged_types("payload", "schema_key").alias("t"))
        found = [dt.types_by_key(r["t"])['["v"]']["v"] for r in both.unionByName(each.drop("n")).collect()]
        assert dt.merge(*found[1:]) == found[0], (a, b)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "A", "a_2", "A_2", "b", "B", "é", "É"]), max_size=8, unique=True), st.lists(st.sampled_from(["a", "B_2"])))
def test_distinct_names(names, taken):
    made = dt.distinct_names(names, taken)
    assert len({n.lower() for n in made} | {t.lower() for t in taken}) == len(made) + len({t.lower() for t in taken})
    assert all(new == old or new.startswith(f"{old}_") for old, new in zip(names, made, strict=True))


def test_declared_fields_keep_their_types(spark):
    path = land(spark, [whole(id=5, title="x")])
    fields = sources.landed_fields(spark, path)
    schema = sources.with_fields(schemas.DOCUMENT, fields)
    assert schema.fields[: len(schemas.DOCUMENT.fields)] == schemas.DOCUMENT.fields
    assert sources.column_names(schema) == schema.names
