"""A table that is kept up to date equals one made at once, and only what changes is rewritten."""

import random

import pytest
from pyspark.sql import functions as F

from lakestrata import plans
from lakestrata.plans.upkeep import batch_facts, part_of
from lakestrata.session import children, job_folder, work_dir

LOCAL = "imdb_id string, runtime string, genre string, title string"
DOCS = "imdb_id string, company_name string, company_origin_country string, production_country_name string"
PARTS = 8


def local(spark, n=40):
    return spark.createDataFrame([(f"tt{i}", "90", g, "x") for i in range(n) for g in ("a", "b")], LOCAL)


def batch(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def some(seed, n=25, titles=40):
    rng = random.Random(seed)
    return [
        (f"tt{rng.randrange(titles)}", rng.choice(["c1", "c2", "c3", None]), rng.choice(["FR", "US", None]), rng.choice(["F", "G", None]))
        for _ in range(n)
    ]


def same(kept, spark, batches):
    want = plans.unified_movies_rows(local(spark), [batch(spark, b) for b in batches])
    got = kept.table()
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def fresh(spark, name):
    kept = plans.UnifiedMovies(spark, work_dir(spark, "kept"), name, "upkeep_db", PARTS)
    kept.start(local(spark))
    return kept


def test_batches_one_after_the_other(spark):
    kept = fresh(spark, "one_by_one")
    assert kept.table().count() == 0
    held = []
    for number in range(4):
        held.append(some(number))
        kept.add(batch(spark, held[-1]), number)
        same(kept, spark, held)
    # A batch that comes again, changed, replaces what it said.
    held[1] = some(99, 5)
    kept.add(batch(spark, held[1]), 1)
    same(kept, spark, held)
    held[2] = []
    kept.add(batch(spark, []), 2)
    same(kept, spark, held)


def partition_places(spark, kept):
    out = {}
    for row in spark.sql(f"SHOW PARTITIONS {kept.name}").collect():
        spec = row["partition"].replace("=", " = ")
        found = spark.sql(f"DESCRIBE FORMATTED {kept.name} PARTITION ({spec})")
        out[int(row["partition"].partition("=")[2])] = found.filter("col_name = 'Location'").first()["data_type"]
    return out


def part(spark, title):
    return spark.range(1).select(part_of(F.lit(title), PARTS)).first()[0]


def test_only_touched_parts_are_rewritten(spark):
    kept = fresh(spark, "touched")
    first = [(f"tt{i}", f"c{i}", "FR", "F") for i in range(40)]
    assert kept.add(batch(spark, first), 1) == list(range(PARTS))
    before = partition_places(spark, kept)
    # Nothing new: nothing is rewritten.
    assert kept.add(batch(spark, first[:7]), 2) == []
    assert partition_places(spark, kept) == before
    # A title with another country; a company of another title with another origin.
    third = [("tt3", "c3", "FR", "G"), ("other", "c8", "US", "F")]
    want = sorted({part(spark, t) for t in ("tt3", "other", "tt8")})
    assert kept.add(batch(spark, third), 3) == want
    after = partition_places(spark, kept)
    assert {p for p in after if after[p] != before[p]} == set(want)
    same(kept, spark, [first, first[:7], third])
    old = spark.read.parquet(before[want[0]]).count()
    kept.vacuum()
    same(kept, spark, [first, first[:7], third])
    assert old > 0
    with pytest.raises(Exception):
        spark.read.parquet(before[want[0]]).count()


def test_the_plan_reads_the_touched_parts_only(spark):
    kept = fresh(spark, "plan")
    kept.add(batch(spark, [(f"tt{i}", f"c{i}", "FR", "F") for i in range(40)]), 1)
    text = kept.rows([2])._jdf.queryExecution().executedPlan().toString()
    titles = [line for line in text.splitlines() if "FileScan" in line and "runtime" in line]
    assert titles and all("(part#" in line.split("PartitionFilters")[1] for line in titles)
    facts = kept.facts([0, 2], [2])
    files = facts.select(F.input_file_name().alias("f")).distinct().collect()
    assert files and all("/part=2/" in r["f"] for r in files)


def test_a_batch_is_read_once(spark):
    df = batch(spark, some(1))
    text = batch_facts(df, 1, PARTS)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan ExistingRDD") == 1 and text.count("Exchange") == 1


def test_a_run_that_fails_can_be_run_again(spark, monkeypatch):
    kept = fresh(spark, "fails")
    held = [some(1)]
    kept.add(batch(spark, held[0]), 1)
    with monkeypatch.context() as patch:
        patch.setattr(plans.UnifiedMovies, "_rewrite", lambda *_: (_ for _ in ()).throw(RuntimeError))
        with pytest.raises(RuntimeError):
            kept.add(batch(spark, some(2)), 2)
    same(kept, spark, held)
    held.append(some(2))
    kept.add(batch(spark, held[1]), 2)
    same(kept, spark, held)
    # It fails while it replaces a batch; what only that batch said has to go all the same.
    held[1] = [("tt39", "c1", "US", "F")]
    for fails in (True, False):
        with monkeypatch.context() as patch:
            if fails:
                patch.setattr(plans.UnifiedMovies, "_rewrite", lambda *_: (_ for _ in ()).throw(RuntimeError))
                with pytest.raises(RuntimeError):
                    kept.add(batch(spark, held[1]), 2)
            else:
                kept.add(batch(spark, held[1]), 2)
    same(kept, spark, held)


def test_joined_rows_are_written_by_part_without_a_shuffle(spark):
    kept = fresh(spark, "sorted_by_part")
    kept.add(batch(spark, some(1)), 1)
    assert "title" not in spark.read.parquet(f"{kept.path}/titles").columns
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = kept.rows(range(PARTS))._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    top = next(i for i, line in enumerate(plan) if "SortMergeJoin" in line)
    assert "part" in plan[top] and not any("Exchange" in line for line in plan[:top])


def test_facts_of_a_first_batch_are_written_once_and_not_compared(spark):
    with job_folder(spark) as folder:
        kept = fresh(spark, "first_batch")
        kept.add(batch(spark, some(1)), 1)
        staged = {name.partition("-")[0] for name in children(spark, folder)}
        assert "kept" in staged and not staged & {"facts", "changed"}
        assert not [n for n in children(spark, kept.path) if n.startswith("_")]
        same(kept, spark, [some(1)])
