"""Tables are published by a switch in the catalog and keep their identity."""

import os

import pytest
from pyspark.sql import functions as F

from lakestrata import schemas, sinks, sources
from lakestrata.layout import new_version
from lakestrata.session import versions, work_dir
from lakestrata.sinks import catalog


def rows(spark, n, **columns):
    made = {k: F.expr(v) for k, v in columns.items()}
    return spark.range(0, n, 1, 2).select("id", *[c.alias(k) for k, c in made.items()])


def properties(spark, name):
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def location(spark, name):
    found = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Location'").first()
    return found["data_type"]


def test_a_run_that_dies_before_the_switch_leaves_the_old_rows(spark, monkeypatch):
    path = work_dir(spark, "table")
    name = sinks.save_table(rows(spark, 5), "publish_db", "dies", path)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(catalog, "switch", killed)
        # Nothing is cleaned up by a process that is killed.
        patch.setattr(catalog, "remove_folder", lambda *_: None)
        with pytest.raises(KeyboardInterrupt):
            sinks.save_table(rows(spark, 9, more="'x'"), "publish_db", "dies", path)
    assert len(versions(spark, path)) == 2
    assert spark.table(name).columns == ["id"] and spark.table(name).count() == 5
    with monkeypatch.context() as patch:
        patch.setattr(catalog, "switch", killed)
        with pytest.raises(KeyboardInterrupt):
            sinks.save_table(rows(spark, 7), "publish_db", "dies", path)
    assert len(versions(spark, path)) == 2
    sinks.save_table(rows(spark, 3), "publish_db", "dies", path)
    assert spark.table(name).count() == 3 == sources.read_parquet(spark, path).count()


def test_properties_and_the_table_stay(spark):
    path = work_dir(spark, "table")
    name = sinks.save_table(rows(spark, 5, a="'x'"), "publish_db", "stays", path)
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('owner.team' = 'it''s films', 'k' = '1')")
    first = location(spark, name)
    created = spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Created Time'").first()[1]
    sinks.save_table(rows(spark, 6, a="'y'", b="id * 2", c="named_struct('x y', id)"), "publish_db", "stays", path)
    assert location(spark, name) != first
    assert spark.sql(f"DESCRIBE FORMATTED {name}").filter("col_name = 'Created Time'").first()[1] == created
    assert {"owner.team", "k"} <= set(properties(spark, name))
    assert spark.table(name).columns == ["id", "a", "b", "c"]
    assert spark.table(name).agg(F.sum("b"), F.sum("c.`x y`")).first() == (30, 15)
    # A column less: defined anew, with the properties.
    sinks.save_table(rows(spark, 2, b="'text'"), "publish_db", "stays", path)
    assert spark.table(name).columns == ["id", "b"] and spark.table(name).count() == 2
    assert {"owner.team", "k"} <= set(properties(spark, name))


def test_partitioned_versions(spark):
    path = work_dir(spark, "table")
    name = sinks.save_table(rows(spark, 9, p="id % 3"), "publish_db", "parts", path, partition_by=["p"])
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('k' = '1')")
    again = rows(spark, 8, p="id % 4 + 1", q="'q'")
    sinks.save_table(again, "publish_db", "parts", path, partition_by=["p"])
    got = spark.table(name)
    assert got.columns == ["id", "q", "p"]
    assert sorted(map(tuple, got.select("id", "p").collect())) == [(i, i % 4 + 1) for i in range(8)]
    plan = got.filter("p = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p" in plan
    assert properties(spark, name)["k"] == "1"


def test_old_versions_go_and_readers_of_the_last_one_finish(spark):
    path = work_dir(spark, "table")
    name = sinks.save_table(rows(spark, 1), "publish_db", "old", path)
    for n in (2, 3, 4):
        reader = spark.table(name)
        sinks.save_table(rows(spark, n), "publish_db", "old", path, keep_versions=1)
        assert reader.count() == n - 1
        assert spark.table(name).count() == n == sources.read_parquet(spark, path).count()
    assert len(versions(spark, path)) == 2
    sinks.save_table(rows(spark, 5), "publish_db", "old", path)
    assert len(versions(spark, path)) == 1 and spark.read.parquet(path).count() == 5


def test_data_from_before_there_were_versions(spark):
    path = work_dir(spark, "table")
    spark.sql("CREATE DATABASE IF NOT EXISTS publish_db")
    rows(spark, 4).write.parquet(path)
    spark.sql(f"CREATE TABLE publish_db.plain (id bigint) USING parquet LOCATION '{path}'")
    assert sources.read_parquet(spark, path).count() == 4
    for n in (5, 6):
        sinks.save_table(rows(spark, n), "publish_db", "plain", path)
        assert spark.table("publish_db.plain").count() == n == sources.read_parquet(spark, path).count()
    held = os.listdir(path.removeprefix("file://").removeprefix("file:"))
    assert all(x.startswith(("version=", "_", ".")) for x in held)


def test_versions_sort_by_time():
    made = [new_version() for _ in range(50)]
    assert [v.split("-")[0] for v in made] == sorted(v.split("-")[0] for v in made)


def test_the_sink_moves_no_folder(spark, monkeypatch):
    moved = []
    monkeypatch.setattr("lakestrata.session.replaced_folder", lambda *a: moved.append(a))
    assert not hasattr(catalog, "replaced_folder")
    path = work_dir(spark, "table")
    sinks.save_table(rows(spark, 2), schemas.REFINED_DATABASE, "not_moved", path)
    sinks.save_table(rows(spark, 3), schemas.REFINED_DATABASE, "not_moved", path)
    assert not moved and sources.read_parquet(spark, path).count() == 3
