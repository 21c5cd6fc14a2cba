"""The given tables in the shapes the lake reads.

Titles are orders, artists are customers. The documents of a title are its line
items: the supplier and, for returned items, also its nation are the companies,
the supplier's region is the country. Items with line status ``O`` have no
country, so their documents are incomplete. The three batches are the return
flags. Only projections and joins on keys are used, so the inputs grow with the
tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.schemas import DOCUMENT, INT, struct

ARTIST = "Customer#000000007"
SPELLINGS = {"AMERICA": "US"}
BATCHES = ["A", "N", "R"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def title_id(key: str) -> Column:
    return F.concat(F.lit("tt"), F.col(key).cast("string"))


def local_file(spark: SparkSession, sf_dir: str, series: bool = False) -> DataFrame:
    """Orders with their customer, in the columns of a delimited source file."""
    orders = table(spark, sf_dir, "orders")
    customers = table(spark, sf_dir, "customer")
    finish = {"anoTermino": F.date_format(F.date_add("o_orderdate", 400), "yyyy")}
    columns = {
        "id": title_id("o_orderkey"),
        "tituloPincipal": F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")),
        "tituloOriginal": F.concat(F.lit("Pedido "), F.col("o_orderkey").cast("string")),
        "anoLancamento": F.date_format("o_orderdate", "yyyy"),
        **(finish if series else {}),
        "tempoMinutos": F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(
            F.dayofyear("o_orderdate").cast("string")
        ),
        "genero": F.replace("o_orderpriority", F.lit("-"), F.lit(",")),
        "notaMedia": F.dayofmonth("o_orderdate").cast("string"),
        "numeroVotos": F.col("o_custkey").cast("string"),
        "generoArtista": F.col("c_mktsegment"),
        "personagem": F.col("o_orderpriority"),
        "nomeArtista": F.col("c_name"),
        "anoNascimento": F.col("c_nationkey").cast("string"),
        "anoFalecimento": F.lit(None).cast("string"),
        "profissao": F.concat_ws(",", "c_mktsegment", "o_orderstatus"),
        "titulosMaisConhecidos": F.col("o_orderpriority"),
    }
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(*[c.alias(n) for n, c in columns.items()])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as documents with nested lists, with their ``batch``."""
    def field(name: str) -> T.DataType:
        return DOCUMENT[name].dataType

    def company(key: str, name: str, origin: str) -> Column:
        return F.struct(
            F.col(key).cast("bigint").alias("id"),
            F.lit(None).cast("string").alias("logo_path"),
            F.col(name).alias("name"),
            F.col(origin).alias("origin_country"),
        )

    def language(flag: str, kind: str) -> Column:
        return F.struct(
            F.lit(kind).alias("english_name"),
            F.col(flag).alias("iso_639_1"),
            F.concat(F.lit(f"{kind} "), F.col(flag)).alias("name"),
        )

    # The dimensions take the shape of nested lists before they meet the lines.
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        "p_name",
        "p_type",
        "p_brand",
        F.transform(
            F.split("p_name", " "),
            lambda word, i: F.struct(i.cast("bigint").alias("id"), word.alias("name")),
        ).alias("genres"),
    )
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("l_suppkey"),
            company("s_suppkey", "s_name", "n_name").alias("supplier"),
            company("n_nationkey", "n_name", "r_name").alias("nation"),
            F.struct(
                F.col("r_regionkey").cast("string").alias("iso_3166_1"),
                F.col("r_name").alias("name"),
            ).alias("country"),
        )
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus"
        )
        .join(parts, "l_partkey")
        .join(suppliers, "l_suppkey")
    )
    columns = {
        "id": F.col("l_linenumber").cast("bigint"),
        "imdb_id": title_id("l_orderkey"),
        "title": F.col("p_name"),
        "homepage": F.col("p_type"),
        "overview": F.col("p_brand"),
        "poster_path": F.lit(None).cast("string"),
        "tagline": F.lit(""),
        "video": F.col("l_linestatus") == "F",
        "backdrop_path": F.lit(None).cast("string"),
        "belongs_to_collection": F.lit(None).cast(field("belongs_to_collection")),
        "genres": F.col("genres"),
        "production_companies": F.when(
            F.col("l_returnflag") == "R", F.array("supplier", "nation")
        ).otherwise(F.array("supplier")),
        "production_countries": F.when(F.col("l_linestatus") == "F", F.array("country")).otherwise(
            F.array().cast(field("production_countries"))
        ),
        "spoken_languages": F.array(
            language("l_returnflag", "flag"), language("l_linestatus", "status")
        ),
    }
    return lines.select(
        F.col("l_returnflag").alias("batch"), *[c.alias(n) for n, c in columns.items()]
    )


def document_batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Three batches that share titles and companies and together hold every document."""
    docs = documents(spark, sf_dir)
    return [docs.filter(F.col("batch") == b).drop("batch") for b in BATCHES]


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON objects whose fields depend on the type of event."""
    kind = F.col("event_type")
    props = F.from_json("props", struct(k=INT))
    record = F.struct(
        F.col("event_id").alias("id"),
        kind.alias("type"),
        F.when(kind.isin("click", "view"), props["k"]).alias("k"),
        F.when(kind == "purchase", F.col("user_id")).alias("buyer"),
        F.when(kind == "error", F.concat(F.lit("code "), props["k"].cast("string"))).alias("code"),
    )
    # to_json leaves null fields out, which is what makes the fields differ.
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), "event_type", F.to_json(record).alias("payload")
    )


def lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as answered lookups: some failed, some empty, fields by segment."""
    segment = F.col("c_mktsegment")
    record = F.struct(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.when(segment == "BUILDING", F.col("c_nationkey")).alias("nation"),
    )
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(segment == "MACHINERY", 404).otherwise(200).alias("status"),
        F.when(segment == "FURNITURE", "{}").otherwise(F.to_json(record)).alias("payload"),
    )
