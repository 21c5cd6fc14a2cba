"""Contracts of the tables in each zone.

Nothing is inferred from data: readers get one of these schemas, and
``check_contract`` compares a table that carries its own schema (Parquet)
with what a plan expects.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- Fixed values -----------------------------------------------------------
# Column names of the two delimited source files, with the
# name each gets in the trusted zone. They have to match the files as they are
# delivered (the spelling "tituloPincipal" included) and the tables consumers
# already query.

MOVIE_RENAMES = {
    "id": "imdb_id",
    "tituloPincipal": "title",
    "tituloOriginal": "original_title",
    "anoLancamento": "release_year",
    "tempoMinutos": "runtime",
    "genero": "genre",
    "notaMedia": "vote_average",
    "numeroVotos": "vote_count",
    "generoArtista": "artist_gender",
    "personagem": "character",
    "nomeArtista": "artist_name",
    "anoNascimento": "birth_year",
    "anoFalecimento": "death_year",
    "profissao": "profession",
}
SERIES_ONLY_RENAMES = {"anoTermino": "finish_year"}
LOCAL_UNUSED = ["titulosMaisConhecidos"]

# Columns of a trusted local table that the refined tables leave out.
REFINED_UNUSED = ["title", "artist_gender", "character", "artist_name", "birth_year", "death_year"]

# Document fields that the trusted zone leaves out.
DOCUMENT_UNUSED = ["backdrop_path", "belongs_to_collection", "id"]

# Nested lists of a document: trusted column -> field of the list element.
DOCUMENT_LISTS = {
    "genres": {"genre_id": "id", "genre_name": "name"},
    "production_companies": {
        "company_id": "id",
        "company_name": "name",
        "company_origin_country": "origin_country",
    },
    "production_countries": {
        "production_country_iso_3166_1": "iso_3166_1",
        "production_country_name": "name",
    },
    "spoken_languages": {
        "spoken_language_english_name": "english_name",
        "spoken_language_iso_639_1": "iso_639_1",
        "spoken_language_name": "name",
    },
}

# Country spellings made equal in the trusted zone.
COUNTRY_SPELLINGS = {"United States of America": "US"}

# Records per landed JSON file.
CHUNK_SIZE = 100

# Catalog names.
TRUSTED_DATABASE = "dl_trusted_zone"
REFINED_DATABASE = "dl_refined_zone"
UNIFIED_MOVIES = "unified_movies_table"
UNIFIED_SERIES = "unified_series_table"
# --- End of fixed values ----------------------------------------------------

# Earlier versions of a table's data that its job leaves, for queries that still read them.
KEEP_VERSIONS = 1

INT, LONG, STRING, BOOLEAN = T.IntegerType(), T.LongType(), T.StringType(), T.BooleanType()


def struct(**columns: T.DataType) -> T.StructType:
    """Schema with these nullable columns."""
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def structs(**fields: T.DataType) -> T.ArrayType:
    """Type of a list of objects with these fields."""
    return T.ArrayType(struct(**fields))


def file_schema(header: Iterable[str]) -> T.StructType:
    """All-string schema of a delimited file with this header."""
    return struct(**dict.fromkeys(header, STRING))


SERIES_RENAMES = MOVIE_RENAMES | SERIES_ONLY_RENAMES

DOCUMENT = struct(
    id=LONG,
    imdb_id=STRING,
    title=STRING,
    homepage=STRING,
    overview=STRING,
    poster_path=STRING,
    tagline=STRING,
    video=BOOLEAN,
    backdrop_path=STRING,
    belongs_to_collection=struct(id=LONG, name=STRING),
    genres=structs(id=LONG, name=STRING),
    production_companies=structs(id=LONG, logo_path=STRING, name=STRING, origin_country=STRING),
    production_countries=structs(iso_3166_1=STRING, name=STRING),
    spoken_languages=structs(english_name=STRING, iso_639_1=STRING, name=STRING),
)

# What the refined plans rely on in the trusted tables.
TRUSTED_LOCAL_KEYS = struct(imdb_id=STRING, runtime=STRING)
TRUSTED_DOCUMENT_KEYS = struct(
    imdb_id=STRING,
    company_name=STRING,
    company_origin_country=STRING,
    production_country_name=STRING,
)


class ContractError(ValueError):
    """A table does not have the columns or types a plan relies on."""


def check_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Return ``df`` unchanged if it has every contract column with its type.

    Reads the schema only; starts no Spark job.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: want {f.dataType.simpleString()}, "
        f"have {found[f.name].simpleString() if f.name in found else 'nothing'}"
        for f in contract.fields
        if found.get(f.name) != f.dataType
    ]
    if wrong:
        raise ContractError("; ".join(wrong))
    return df
