import random

from pyspark.sql import functions as F

from lakestrata import operators as op
from lakestrata import plans
from lakestrata.operators.unnest import cut_products
from lakestrata.schemas import DOCUMENT


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_split_keeps_blanks_and_empty_items_and_drops_null(spark):
    df = spark.createDataFrame([(1, "a,b, c,"), (2, ""), (3, None)], "id int, genre string")
    assert rows(op.explode_text(df, "genre")) == [
        (1, " c"), (1, ""), (1, "a"), (1, "b"), (2, "")
    ]
    assert (3, None) in rows(op.explode_text(df, "genre", keep_empty=True))


def test_separator_is_literal_text(spark):
    df = spark.createDataFrame([("a|b.c",)], "x string")
    assert rows(op.explode_text(df, "x", sep="|")) == [("a",), ("b.c",)]
    assert rows(op.explode_text(df, "x", sep=".")) == [("a|b",), ("c",)]


def test_two_lists_give_their_product(spark):
    df = spark.createDataFrame([("a,b", "x,y,z")], "genre string, profession string")
    assert op.explode_text(df, "genre", "profession").count() == 6


def document(**given):
    return {f.name: None for f in DOCUMENT} | {"imdb_id": "tt1"} | given


FULL = {
    "genres": [{"id": 1, "name": "g"}],
    "production_companies": [
        {"id": 1, "logo_path": "l", "name": "c", "origin_country": "US"},
        {"id": 2, "logo_path": None, "name": None, "origin_country": None},
    ],
    "production_countries": [{"iso_3166_1": "US", "name": "United States of America"}],
    "spoken_languages": [{"english_name": "e", "iso_639_1": "i", "name": "n"}],
}


def test_document_rows(spark):
    docs = [
        document(**FULL),
        document(**FULL | {"genres": []}),
        document(**FULL | {"spoken_languages": None}),
    ]
    df = spark.createDataFrame(docs, DOCUMENT)
    got = plans.trusted_document_rows(df)
    assert got.columns == [
        "imdb_id", "title", "homepage", "overview", "poster_path", "tagline", "video",
        "genre_id", "genre_name", "company_id", "company_name", "company_origin_country",
        "production_country_iso_3166_1", "production_country_name",
        "spoken_language_english_name", "spoken_language_iso_639_1", "spoken_language_name",
    ]
    assert {(r.company_name, r.production_country_name) for r in got.collect()} == {
        ("c", "US"), (None, "US")
    }
    assert got.count() == 2
    assert plans.trusted_document_rows(df, keep_empty=True).count() == 6


def test_row_count_is_the_sum_of_the_products_of_list_lengths(spark):
    rng = random.Random(3)
    docs, want = [], 0
    for _ in range(60):
        sizes = {name: rng.randrange(4) for name in FULL}
        product = 1
        for size in sizes.values():
            product *= size
        want += product
        docs.append(document(**{n: FULL[n][:1] * size for n, size in sizes.items()}))
    df = spark.createDataFrame(docs, DOCUMENT)
    assert plans.trusted_document_rows(df).count() == want


def test_products_in_pieces_are_the_same_rows(spark):
    rng = random.Random(6)
    docs = [
        document(
            imdb_id=f"tt{i}",
            genres=[{"id": j, "name": f"g{j}"} for j in range(rng.randrange(6))],
            production_companies=rng.choice([None, [], [{"id": j, "name": "c"} for j in range(rng.randrange(9))]]),
            production_countries=[{"name": f"n{j}"} for j in range(rng.randrange(4))],
            spoken_languages=[{"name": f"l{j}"} for j in range(1 + rng.randrange(20))],
        )
        for i in range(40)
    ]
    df = spark.createDataFrame(docs, DOCUMENT)
    for keep_empty in (False, True):
        want = rows(plans.trusted_document_rows(df, keep_empty=keep_empty))
        for block in (1, 2, 7, 10**6):
            assert rows(plans.trusted_document_rows(df, keep_empty=keep_empty, block_rows=block)) == want


def test_pieces_have_bounded_products(spark):
    df = spark.createDataFrame(
        [(1, list(range(50)), list(range(30)), list(range(20))), (2, [1], [], None), (3, [1], [2], list(range(900)))],
        "id int, a array<int>, b array<int>, c array<int>",
    )
    got = cut_products(df, ["a", "b", "c"], 100).collect()
    for r in got:
        assert len(r.a) * max(len(r.b), 1) * max(len(r.c or []), 1) <= 100
    for i, want in ((1, 30_000), (3, 900)):
        assert sum(len(r.a) * len(r.b) * len(r.c) for r in got if r.id == i) == want
    assert [tuple(r) for r in got if r.id == 2] == [(2, [1], [], None)]
    assert sum(r.id == 3 for r in got) == 9


def test_a_record_with_most_rows_is_shared_by_tasks(spark):
    many = [{"id": j, "name": "x"} for j in range(60)]
    huge = document(genres=many, production_companies=many, production_countries=[{"name": "n"}], spoken_languages=[{"name": "l"}])
    df = spark.createDataFrame([document(**FULL), huge, document(**FULL)], DOCUMENT).coalesce(1)
    got = plans.trusted_document_rows(df, block_rows=100)
    per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) > 4 and max(per_task) < 3600 / 3
    assert sum(per_task) == 3600 + 4
    whole = plans.trusted_document_rows(df)
    assert max(r["count"] for r in whole.groupBy(F.spark_partition_id()).count().collect()) == 3604
