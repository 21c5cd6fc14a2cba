import pytest
from pyspark.sql import functions as F

from lakestrata import operators as op
from lakestrata.functions import path_date_parts, schema_key, to_int
from lakestrata.schemas import (
    INT,
    LONG,
    STRING,
    ContractError,
    check_contract,
    struct,
)


def test_drop_and_rename_ignore_unknown_names_unless_strict(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    assert op.drop_fields(df, ["y", "nope"]).columns == ["x"]
    assert op.rename_fields(df, {"y": "z", "nope": "q"}).columns == ["x", "z"]
    with pytest.raises(ValueError, match="nope"):
        op.drop_fields(df, ["nope"], strict=True)
    with pytest.raises(ValueError, match="nope"):
        op.rename_fields(df, {"nope": "q"}, strict=True)


def test_keep_equal_drops_null_and_is_off_without_a_value(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert op.keep_equal(df, "x", "a").count() == 1
    assert op.keep_equal(df, "x", None).count() == 3


def test_canonicalise_literals_and_table(spark):
    df = spark.createDataFrame([("United States of America",), ("France",), (None,)], "c string")
    got = op.canonicalise(df, "c", {"United States of America": "US"})
    assert sorted(str(r.c) for r in got.collect()) == ["France", "None", "US"]
    names = spark.createDataFrame(
        [("United States of America", "US")], "spelling string, canonical string"
    )
    assert op.canonicalise_from(df, "c", names).exceptAll(got).isEmpty()
    assert op.canonicalise(df, "c", {}).exceptAll(df).isEmpty()


NUMBERS = [
    "90", "090", " 90 ", "90.7", "-3.2", "90.", "+5", "\t7\n", "2147483647", "-2147483648",
    "x", "", "n/a", "1e2", "1.2.3", "1 2", "--1", "99999999999", "2147483648", "0x1F",
]


def test_to_int_gives_what_a_cast_without_ansi_gives(spark):
    df = spark.createDataFrame([(n,) for n in NUMBERS] + [(None,)], "n string")
    got = {r.n: r.i for r in df.select("n", to_int("n").alias("i")).collect()}
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        want = {r.n: r.i for r in df.select("n", F.col("n").cast("int").alias("i")).collect()}
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert got == want
    assert (got["90"], got["090"], got["90.7"], got["x"], got[None]) == (90, 90, 90, None, None)


def test_contract_names_what_is_wrong(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    assert check_contract(df, struct(x=STRING, y=INT)) is df
    with pytest.raises(ContractError, match="y: want bigint, have int; z: want string, have noth"):
        check_contract(df, struct(x=STRING, y=LONG, z=STRING))


def test_path_date_parts(spark):
    df = spark.createDataFrame([("s3://b/raw/Movies/2023/11/06/movies.csv",)], "p string")
    row = df.select(*[c.alias(n) for n, c in path_date_parts("p").items()]).first()
    assert row.asDict() == {"year": "2023", "month": "11", "day": "06"}


def test_schema_key_is_sorted_unambiguous_and_null_for_non_objects(spark):
    docs = ['{"b":1,"a":2}', '{"a":{"z":1},"b":null}', '{"a,b":1}', "[1]", "oops", "{}", None]
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    keys = [r.k for r in df.select(schema_key("d").alias("k")).collect()]
    assert keys == ['["a","b"]', '["a","b"]', '["a,b"]', None, None, "[]", None]
