"""The refined movies table: agreed cases, and equality with the step-by-step form."""

import random

import pytest

from lakestrata import plans
from lakestrata.operators import distinct_rows, values_by_batch
from lakestrata.schemas import DOCUMENT, TRUSTED_DOCUMENT_KEYS
from workload.stepwise import unified_movies_stepwise

LOCAL = (
    "imdb_id string, title string, original_title string, release_year string, runtime string,"
    " genre string, vote_average string, vote_count string, artist_gender string,"
    " character string, artist_name string, birth_year string, death_year string,"
    " profession string"
)


def local_table(spark, titles):
    """One row per (imdb_id, runtime, genre)."""
    return spark.createDataFrame(
        [(i, "t", "o", "1990", r, g, "5", "9", "m", "c", "a", "1", None, "p") for i, r, g in titles],
        LOCAL,
    )


def batch(spark, rows):
    return spark.createDataFrame(rows, TRUSTED_DOCUMENT_KEYS)


def picked(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def test_columns(spark):
    local = local_table(spark, [("a", "90", "g")])
    b = [batch(spark, [("a", "c", "US", "US")])] * 3
    head = ["imdb_id", "original_title", "release_year", "runtime", "genre", "vote_average",
            "vote_count", "profession", "company_name"]
    origin = "company_origin_country"
    one = plans.unified_movies_rows(local, b)
    assert one.columns == [*head, origin, "production_country_name"]
    assert one.schema["runtime"].dataType.simpleString() == "int"
    three = plans.unified_movies_rows(local, b, origin_per_batch=True)
    assert three.columns == [*head, *[f"{origin}_{i}" for i in (1, 2, 3)],
                             "production_country_name"]


def test_unmatched_titles_and_null_values(spark):
    local = local_table(spark, [("a", "90", "g"), ("b", "x", "g"), ("c", None, "g"), (None, "1", "g")])
    b = [
        batch(spark, [("a", "c1", "US", "US"), ("b", None, "US", "US"), (None, "c1", "US", "US")]),
        batch(spark, [("a", "c1", "US", "US"), ("a", None, "FR", None)]),
    ]
    got = plans.unified_movies_rows(local, b)
    assert picked(got, "imdb_id", "runtime", "company_name", "production_country_name") == [
        ("a", 90, "c1", "US")
    ]
    kept = plans.unified_movies_rows(local, b, keep_unmatched=True)
    assert picked(kept, "imdb_id", "runtime", "company_name", "production_country_name") == [
        ("a", 90, "c1", "US"), ("b", None, None, "US"), ("c", None, None, None),
        (None, 1, None, None),
    ]


def test_origin_conflict(spark):
    local = local_table(spark, [("a", "90", "g"), ("b", "90", "g")])
    b = [
        batch(spark, [("a", "c", "US", "US"), ("b", "c", "FR", "US"), ("a", "d", None, "US")]),
        batch(spark, [("b", "c", "US", "US")]),
        batch(spark, [("z", "other", "US", "US")]),
    ]
    columns = [f"company_origin_country_{i}" for i in (1, 2, 3)]
    each = plans.unified_movies_rows(local, b, origin_per_batch=True)
    assert picked(each, "imdb_id", "company_name", *columns) == [
        ("a", "c", "FR", "US", None), ("a", "c", "US", "US", None), ("a", "d", None, None, None),
        ("b", "c", "FR", "US", None), ("b", "c", "US", "US", None),
    ]
    one = plans.unified_movies_rows(local, b)
    assert picked(one, "imdb_id", "company_name", "company_origin_country") == [
        ("a", "c", "FR"), ("a", "c", "US"), ("a", "d", None), ("b", "c", "FR"), ("b", "c", "US"),
    ]


def test_null_origin_counts_as_a_value_per_batch(spark):
    b = [batch(spark, [("a", "c", "US", "US"), ("a", "c", None, "US"), ("a", None, "US", "US")])]
    got = values_by_batch(b, "company_name", "company_origin_country", ["o"])
    assert picked(got, "company_name", "o") == [("c", "US"), ("c", None)]


def test_runtimes_are_compared_as_text(spark):
    local = local_table(spark, [("a", "90", "g"), ("a", "090", "g"), ("a", "90", "g")])
    b = [batch(spark, [("a", "c", "US", "US")])]
    got = plans.unified_movies_rows(local, b)
    assert picked(got, "imdb_id", "runtime") == [("a", 90), ("a", 90)]
    assert distinct_rows(got).count() == 1


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_step_by_step_form(spark, seed):
    rng = random.Random(seed)

    def some(prefix, n):
        return rng.choice([None] + [f"{prefix}{i}" for i in range(n)])

    local = local_table(
        spark,
        [(some("t", 9), rng.choice(["90", "090", "x", None]), some("g", 3)) for _ in range(40)],
    )
    batches = [
        batch(spark, [(some("t", 9), some("c", 5), some("o", 3), some("n", 3)) for _ in range(30)])
        for _ in range(3)
    ]
    want = unified_movies_stepwise(local, batches)
    got = plans.unified_movies_rows(local, batches, origin_per_batch=True)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert got.count() > 0


@pytest.mark.parametrize("per_batch", [True, False])
def test_from_documents_equals_the_way_over_trusted_tables(spark, per_batch):
    rng = random.Random(8)

    def items(*fields):
        length = rng.randrange(4)
        if rng.random() < 0.1:
            return None
        return [{f: rng.choice([None, f"{f}1", f"{f}2"]) for f in fields} for _ in range(length)]

    def doc():
        empty = {f.name: None for f in DOCUMENT}
        return empty | {
            "imdb_id": rng.choice(["t1", "t2", "t3", "t4", None]),
            "genres": items("name"),
            "production_companies": items("name", "origin_country"),
            "production_countries": items("name"),
            "spoken_languages": items("name"),
        }

    batches = [spark.createDataFrame([doc() for _ in range(15)], DOCUMENT) for _ in range(3)]
    local = local_table(spark, [(f"t{i}", "1", "g") for i in range(6)])
    spellings = {"name1": "US"}
    trusted = [plans.trusted_document_rows(b, spellings) for b in batches]
    want = plans.unified_movies_rows(local, trusted, per_batch, True)
    got = plans.unified_movies_from_documents(local, batches, spellings, per_batch, True)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert got.count() > 6


def test_series(spark):
    df = spark.createDataFrame(
        [("a", "t", "o", "1990", "1991", "90", "g", "5", "9", "m", "c", "a", "1", None, "p")],
        LOCAL.replace("release_year string,", "release_year string, finish_year string,"),
    )
    got = plans.series_rows(df)
    assert got.columns == ["imdb_id", "original_title", "release_year", "finish_year", "runtime",
                           "genre", "vote_average", "vote_count", "profession"]
    assert got.first().runtime == 90
