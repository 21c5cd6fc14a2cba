"""Queries by name. Each takes the session and the folder of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata import functions as fn
from lakestrata import operators as op
from lakestrata import plans, schemas, sinks, sources
from lakestrata.layout import INDEX, day_path
from lakestrata.schemas import INT, LONG, STRING
from lakestrata.session import tune, work_dir
from workload.inputs import (
    ARTIST,
    BATCHES,
    SPELLINGS,
    document_batches,
    documents,
    event_documents,
    local_file,
    lookups,
    table,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_DATE = date(2023, 11, 6)
EVENT = schemas.struct(id=LONG, type=STRING, k=INT, buyer=LONG, code=STRING)
LOOKUP = schemas.struct(id=LONG, name=STRING, nation=INT)


def query(build: Query) -> Query:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(tune(spark), sf_dir)
    return build


# --- Sources and sinks: written from a given table, then read back -----------


@query
def scan_delimited(spark, d):
    rows = table(spark, d, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_acctbal").cast("string").alias("balance"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("segment"),
    )
    path = work_dir(spark, "delimited")
    rows.write.options(header=True, sep="|").csv(path)
    return sources.read_delimited(spark, path, schema=schemas.file_schema(rows.columns))


@query
def scan_delimited_with_bad_rows(spark, d):
    """Every third line has a field too many or too few: those set aside, and all others."""
    path, aside = work_dir(spark, "delimited"), work_dir(spark, "aside")
    kind = F.col("c_custkey") % 6
    line = F.concat_ws(
        "|",
        F.col("c_custkey").cast("string"),
        "c_name",
        F.when(kind != 3, F.col("c_mktsegment")),
        F.when(kind == 0, F.lit("one more")),
    )
    lines = table(spark, d, "customer").select(line.alias("id|name|segment"))
    lines.write.option("header", True).option("quote", "").csv(path, sep="\t")
    good, bad = sources.split_bad_rows(spark, path)
    bad.write.parquet(aside)
    found = spark.read.parquet(aside).select(
        F.lit(True).alias("bad"),
        F.substring_index("value", "|", 1).alias("id"),
        F.col("value").alias("name"),
        F.lit(None).cast("string").alias("segment"),
    )
    return good.select(F.lit(False).alias("bad"), "id", "name", "segment").unionByName(found)


@query
def scan_json_arrays(spark, d):
    path = work_dir(spark, "arrays")
    docs = event_documents(spark, d).transform(op.with_schema_key)
    sinks.land_chunks(docs, path, order_by="id")
    return sources.read_document_arrays(spark, path, EVENT)


@query
def scan_json_lines(spark, d):
    path = work_dir(spark, "lines")
    event_documents(spark, d).select("payload").write.text(path)
    return sources.read_document_lines(spark, path, EVENT)


@query
def scan_parquet(spark, d):
    contract = schemas.struct(l_orderkey=LONG, l_suppkey=LONG)
    lines = sources.read_parquet(spark, f"{d}/lineitem.parquet", contract)
    return lines.select("l_orderkey", "l_suppkey")


@query
def read_objects(spark, d):
    path = work_dir(spark, "objects")
    docs = event_documents(spark, d).transform(op.with_schema_key)
    sinks.land_chunks(docs, path, order_by="id")
    objects = sources.read_objects(spark, path)
    return objects.select(F.trim(F.col("content"), F.lit("\n")).alias("content"))


@query
def save_table(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    path = work_dir(spark, "table")
    name = sinks.save_table(parts, schemas.TRUSTED_DATABASE, "parts", path)
    sinks.save_table(parts, schemas.TRUSTED_DATABASE, "parts", path)
    return sources.read_table(spark, name)


FILE_BYTES = 1 << 17


@query
def files_by_size(spark, d):
    """A table in files of a size: all rows, and whether every file's size is near it."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    name = sinks.save_table(
        lines, schemas.TRUSTED_DATABASE, "lines_by_size", work_dir(spark, "sized"), file_bytes=FILE_BYTES
    )
    files = sources.read_table(spark, name).groupBy("_metadata.file_path").agg(
        F.max("_metadata.file_size").alias("size"), F.count("*").alias("rows")
    )
    near = (F.col("size") > FILE_BYTES // 2) & (F.col("size") < FILE_BYTES * 2)
    return files.agg(
        F.sum("rows").alias("rows"), (F.every(near) | (F.count("*") == 1)).alias("in_band")
    )


@query
def land_by_date(spark, d):
    path = work_dir(spark, "dated")
    events = table(spark, d, "events").select("event_id", "event_type", "ts")
    sinks.land_by_date(events, path, RUN_DATE)
    for _ in range(2):
        sinks.land_by_date(events, path, F.col("ts"))
    schema = schemas.struct(event_id=LONG, event_type=STRING, ts=STRING)
    landed = sources.read_landed(spark, path, schema)
    return landed.select("event_id", "event_type", "year", "month", "day")


@query
def land_chunks(spark, d):
    path = work_dir(spark, "chunks")
    docs = event_documents(spark, d).transform(op.with_schema_key)
    sinks.land_chunks(docs, path)
    files = spark.read.text(path).withColumn("file", F.col("_metadata.file_path"))
    per_file = files.groupBy("schema_id", "file").agg(F.count("*").alias("n"))
    bounded = per_file.groupBy("schema_id").agg(
        F.sum("n").alias("records"), (F.max("n") <= schemas.CHUNK_SIZE).alias("bounded")
    )
    return bounded.select("schema_id", "records", "bounded")


# --- Columns and rows --------------------------------------------------------


@query
def drop_and_rename(spark, d):
    customers = table(spark, d, "customer")
    return customers.transform(op.drop_fields, ["c_acctbal", "not_there"]).transform(
        op.rename_fields, {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"}
    )


@query
def project_key(spark, d):
    return table(spark, d, "events").transform(op.project_key, "user_id")


@query
def keep_equal(spark, d):
    return table(spark, d, "part").transform(op.keep_equal, "p_brand", "Brand#13")


@query
def cast_text_to_int(spark, d):
    text = F.when(F.col("p_type") == "ECONOMY", F.col("p_brand")).otherwise(
        F.col("p_retailprice").cast("string")
    )
    parts = table(spark, d, "part").select("p_partkey", text.alias("runtime"))
    return parts.transform(op.to_int_columns, "runtime")


@query
def canonicalise(spark, d):
    segment = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
    customers = table(spark, d, "customer").select("c_custkey", segment.alias("segment"))
    return customers.transform(op.canonicalise, "segment", {"AUTOMOBILE": "CAR"})


@query
def canonicalise_from(spark, d):
    nations = table(spark, d, "nation").select(
        F.col("n_nationkey").cast("string").alias("spelling"), F.col("n_name").alias("canonical")
    )
    customers = table(spark, d, "customer").select(
        "c_custkey", F.col("c_nationkey").cast("string").alias("country")
    )
    return customers.transform(op.canonicalise_from, "country", nations)


@query
def found_lookups(spark, d):
    return lookups(spark, d).transform(op.found)


@query
def failed_lookups(spark, d):
    return lookups(spark, d).transform(op.failed)


@query
def date_parts(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", *[c.alias(n) for n, c in fn.date_parts(F.col("o_orderdate")).items()]
    )


@query
def format_path(spark, d):
    parts = fn.date_parts(F.col("o_orderdate"))
    path = F.format_string("raw/orders/%s/%s/%s/orders.csv", *parts.values())
    return table(spark, d, "orders").select("o_orderkey", path.alias("path"))


# --- Lists -------------------------------------------------------------------


@query
def explode_text(spark, d):
    parts = table(spark, d, "part").select("p_partkey", F.col("p_name").alias("genre"))
    return parts.transform(op.explode_text, "genre", sep=" ")


@query
def explode_two_texts(spark, d):
    parts = table(spark, d, "part").select(
        "p_partkey",
        F.replace("p_name", F.lit(" "), F.lit(",")).alias("genre"),
        F.concat_ws(",", "p_brand", "p_type").alias("profession"),
    )
    return parts.transform(op.explode_text, "genre", "profession")


@query
def explode_structs(spark, d):
    docs = documents(spark, d).select("imdb_id", "id", "production_companies")
    fields = schemas.DOCUMENT_LISTS["production_companies"]
    return docs.transform(op.explode_structs, "production_companies", fields)


@query
def explode_structs_outer(spark, d):
    docs = documents(spark, d).select("imdb_id", "id", "production_countries")
    fields = schemas.DOCUMENT_LISTS["production_countries"]
    return docs.transform(op.explode_structs, "production_countries", fields, keep_empty=True)


# --- Merging -----------------------------------------------------------------


def _order_suppliers(spark, d) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    suppliers = table(spark, d, "supplier").select("s_suppkey", "s_name")
    known = F.when(F.col("l_returnflag") != "N", F.col("s_name"))
    return lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("o_orderkey"), known.alias("supplier")
    )


@query
def collect_companies(spark, d):
    lists = op.collect_distinct(_order_suppliers(spark, d), "o_orderkey", "supplier", "suppliers")
    return lists.select("o_orderkey", F.array_join("suppliers", ",").alias("suppliers"))


@query
def companies_in_segments(spark, d):
    """The lists of companies from segments of two, put together again."""
    rows = _order_suppliers(spark, d)
    segments = op.collect_segments(rows, "o_orderkey", "supplier", "suppliers", size=2)
    whole = segments.groupBy("o_orderkey").agg(
        F.array_sort(F.collect_list(F.struct("segment", "suppliers"))).alias("parts"),
        (F.max(F.size("suppliers")) <= 2).alias("bounded"),
    )
    return whole.select(
        "o_orderkey", F.array_join(F.flatten("parts.suppliers"), ",").alias("suppliers"), "bounded"
    )


@query
def collect_countries(spark, d):
    docs = documents(spark, d).select("imdb_id", F.explode_outer("production_countries").alias("c"))
    docs = docs.select("imdb_id", F.col("c.name").alias("country"))
    lists = op.collect_distinct(docs, "imdb_id", "country", "countries")
    return lists.select("imdb_id", F.array_join("countries", ",").alias("countries"))


@query
def known_pairs(spark, d):
    return op.known_pairs(_order_suppliers(spark, d), "o_orderkey", "supplier")


@query
def attach_column(spark, d):
    lists = op.collect_distinct(_order_suppliers(spark, d), "o_orderkey", "supplier", "suppliers")
    text = lists.select("o_orderkey", F.array_join("suppliers", ",").alias("suppliers"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return op.attach(orders, text, "o_orderkey", "suppliers")


@query
def attach_and_explode(spark, d):
    lists = op.collect_distinct(_order_suppliers(spark, d), "o_orderkey", "supplier", "suppliers")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    joined = op.attach(orders, lists, "o_orderkey", "suppliers")
    return joined.transform(op.explode_list, "suppliers", "supplier").transform(op.distinct_rows)


@query
def attach_and_explode_kept(spark, d):
    lists = op.collect_distinct(_order_suppliers(spark, d), "o_orderkey", "supplier", "suppliers")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    joined = op.attach(orders, lists, "o_orderkey", "suppliers")
    return joined.transform(op.explode_list, "suppliers", "supplier", keep_empty=True)


@query
def values_by_batch(spark, d):
    """Status values of a brand per batch, as the origins of a company would be."""
    lines = table(spark, d, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus")
    parts = table(spark, d, "part").select("p_partkey", "p_brand")
    status = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    batches = [
        status.filter(F.col("l_returnflag") == b).select("p_brand", "l_linestatus")
        for b in BATCHES
    ]
    names = ["status_1", "status_2", "status_3"]
    return op.attach(parts, op.values_by_batch(batches, "p_brand", "l_linestatus", names),
                     "p_brand", *names)


@query
def union_batches(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    return op.union_batches([lines.filter(F.col("l_returnflag") == b) for b in BATCHES])


@query
def distinct_rows(spark, d):
    lines = table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus")
    return lines.transform(op.distinct_rows)


@query
def sql_over_named_frames(spark, d):
    """The SQL surface: statements over DataFrames given by name."""
    statement = """
        SELECT DISTINCT o.*, c.c_mktsegment
        FROM {orders} o LEFT JOIN {customers} c ON o.o_custkey = c.c_custkey
    """
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return spark.sql(statement, orders=orders, customers=table(spark, d, "customer"))


@query
def sql_over_temp_views(spark, d):
    """The SQL surface: a union of views, dropped when the plan is made."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    for b in BATCHES:
        lines.filter(F.col("l_returnflag") == b).createOrReplaceTempView(f"batch_{b}")
    rows = spark.sql(" UNION ALL ".join(f"SELECT * FROM batch_{b}" for b in BATCHES))
    for b in BATCHES:
        spark.catalog.dropTempView(f"batch_{b}")
    return rows


# --- Lookups and documents ---------------------------------------------------


def _keys(spark, d) -> DataFrame:
    return table(spark, d, "events").select(F.col("user_id").alias("id"))


@query
def enrich(spark, d):
    return op.enrich(_keys(spark, d), lookups(spark, d), "id")


@query
def enrich_counted(spark, d):
    return op.enrich_counted(_keys(spark, d), lookups(spark, d), "id")


@query
def enrich_filtered(spark, d):
    return op.enrich_filtered(_keys(spark, d), lookups(spark, d), "id")


@query
def chunk_copies(spark, d):
    """Chunks of the documents of all keys, copies as runs, written out again."""
    documents_of_keys = op.enrich_counted(_keys(spark, d), lookups(spark, d), "id")
    runs = documents_of_keys.transform(op.chunk_copies, "status", "id")
    return runs.select("status", "id", "chunk", "copies").transform(op.repeat_copies)


@query
def count_keys(spark, d):
    return op.count_keys(_keys(spark, d), "id")


@query
def unknown_keys(spark, d):
    keys = table(spark, d, "customer").select(F.col("c_custkey").alias("id"))
    return op.unknown_keys(keys, _keys(spark, d), "id")


@query
def schema_keys(spark, d):
    docs = event_documents(spark, d).transform(op.with_schema_key)
    return docs.select("id", "schema_key")


@query
def schema_groups(spark, d):
    return event_documents(spark, d).transform(op.with_schema_key).transform(op.schema_groups)


@query
def chunk_within(spark, d):
    docs = event_documents(spark, d).transform(op.with_schema_key).drop("payload", "event_type")
    return docs.transform(op.chunk_within, "schema_key", "id")


@query
def decode_json(spark, d):
    docs = event_documents(spark, d)
    return docs.select(F.from_json("payload", EVENT).alias("e")).select("e.*")


@query
def encode_chunks(spark, d):
    docs = event_documents(spark, d).transform(op.with_schema_key)
    chunks = docs.transform(op.chunk_within, "schema_key", "id")
    return chunks.transform(op.encode_chunks, "schema_key")


# --- Jobs --------------------------------------------------------------------


@query
def landed_file(spark, d):
    """A local file landed twice for one day and once for another, that day read back."""
    raw = local_file(spark, d)
    source, target = work_dir(spark, "source"), work_dir(spark, "raw")
    raw.write.options(header=True, sep="|").csv(source)
    for day in (RUN_DATE, RUN_DATE, date(2023, 12, 1)):
        plans.run_landing(spark, source, target, day)
    return sources.read_landed_day(spark, target, RUN_DATE)


@query
def landed_lookups(spark, d):
    """Documents of a landed file's keys, landed by set of fields and read back."""
    path = _land_lookups(spark, d)
    return sources.read_document_lines(spark, path, LOOKUP)


@query
def landed_lookup_arrays(spark, d):
    """The same in numbered chunks; whole files, as text."""
    path = _land_lookups(spark, d, order_by="id")
    objects = sources.read_objects(spark, path)
    return objects.select(
        F.regexp_extract("path", "chunk=([0-9]+)", 1).alias("chunk"),
        F.trim(F.col("content"), F.lit("\n")).alias("content"),
    )


def _land_lookups(spark, d, order_by: str | None = None) -> str:
    orders = table(spark, d, "orders")
    raw = orders.select(F.col("o_custkey").cast("string").alias("id"),
                        F.col("o_orderstatus").alias("nomeArtista"))
    local, target = work_dir(spark, "raw"), work_dir(spark, "documents")
    sinks.land_by_date(raw, local, RUN_DATE)
    answers = lookups(spark, d).withColumn("id", F.col("id").cast("string"))
    return plans.run_enrichment(
        spark, local, answers, target, "F", RUN_DATE, order_by=order_by
    )


@query
def trusted_local_movies(spark, d):
    return plans.trusted_local_rows(local_file(spark, d), schemas.MOVIE_RENAMES, None)


@query
def trusted_local_movies_of_artist(spark, d):
    return plans.trusted_local_rows(local_file(spark, d), schemas.MOVIE_RENAMES, ARTIST)


@query
def trusted_local_series(spark, d):
    return plans.trusted_local_rows(local_file(spark, d, series=True), schemas.SERIES_RENAMES, None)


@query
def trusted_documents(spark, d):
    return plans.trusted_document_rows(documents(spark, d).drop("batch"), SPELLINGS)


@query
def trusted_documents_in_blocks(spark, d):
    """The same rows, from pieces of documents of at most five rows each."""
    docs = documents(spark, d).drop("batch")
    return plans.trusted_document_rows(docs, SPELLINGS, block_rows=5)


@query
def refined_series(spark, d):
    return plans.series_rows(trusted_local_series(spark, d))


def _trusted_batches(spark, d) -> list[DataFrame]:
    return [plans.trusted_document_rows(b, SPELLINGS) for b in document_batches(spark, d)]


@query
def unified_movies(spark, d):
    return plans.unified_movies_rows(trusted_local_movies(spark, d), _trusted_batches(spark, d))


@query
def unified_movies_of_artist(spark, d):
    local = trusted_local_movies_of_artist(spark, d)
    return plans.unified_movies_rows(local, _trusted_batches(spark, d))


@query
def unified_movies_origin_per_batch(spark, d):
    return plans.unified_movies_rows(
        trusted_local_movies(spark, d), _trusted_batches(spark, d), origin_per_batch=True
    )


@query
def unified_movies_keep_unmatched(spark, d):
    return plans.unified_movies_rows(
        trusted_local_movies(spark, d), _trusted_batches(spark, d), keep_unmatched=True
    )


@query
def unified_movies_from_documents(spark, d):
    return plans.unified_movies_from_documents(
        trusted_local_movies(spark, d), document_batches(spark, d), SPELLINGS
    )


def _title_documents(spark, d) -> DataFrame:
    """All line items of a title as one document with long lists, and fields of its own."""
    docs = documents(spark, d).withColumns(
        {
            "genres": F.slice("genres", 1, 1),
            "spoken_languages": F.slice("spoken_languages", 2, 1),
        }
    )
    lists = [
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
        for c in ("genres", "production_companies", "production_countries", "spoken_languages")
    ]
    titles = docs.groupBy("imdb_id").agg(F.min("title").alias("title"), *lists)
    odd = F.substring("imdb_id", 3, 20).cast("bigint") % 2 == 1
    return titles.withColumns(
        {
            "budget": F.when(odd, F.length("imdb_id").cast("bigint")),
            "rating": F.when(~odd, F.struct(F.col("imdb_id").alias("of"))),
        }
    )


def _trusted_titles(spark, d, order_by: str | None) -> DataFrame:
    """Those documents through the default landing and the trusted job, read by table name."""
    landed, target = work_dir(spark, "landed"), work_dir(spark, "trusted")
    payloads = _title_documents(spark, d).select("imdb_id", F.to_json(F.struct("*")).alias("payload"))
    rows = payloads.transform(op.with_schema_key)
    sinks.land_chunks(rows, landed, order_by=order_by)
    table_name = f"trusted_titles_{'arrays' if order_by else 'lines'}"
    name = plans.run_documents(spark, landed, target, table_name, arrays=order_by is not None)
    return sources.read_table(spark, name).select(
        "imdb_id",
        F.col("budget").cast("string").alias("budget"),
        F.to_json("rating").alias("rating"),
        "genre_name",
        "company_name",
        "production_country_name",
        "spoken_language_name",
    )


@query
def trusted_documents_landed(spark, d):
    return _trusted_titles(spark, d, None)


@query
def trusted_documents_landed_arrays(spark, d):
    return _trusted_titles(spark, d, "imdb_id")


@query
def trusted_documents_typed(spark, d):
    """Fields with the types the landing has kept, two of them alike but for case."""
    landed, target = work_dir(spark, "landed"), work_dir(spark, "trusted")
    titles = _title_documents(spark, d).drop("budget")
    n = F.length("imdb_id").cast("bigint")
    odd = F.col("rating").isNull()
    payload = F.struct(
        "*",
        F.when(odd, n).alias("budget"),
        F.when(~odd, n + F.lit(0.5)).alias("Budget"),
        F.when(odd, F.array(n, n + 1)).alias("votes"),
    )
    rows = titles.select("imdb_id", F.to_json(payload).alias("payload"))
    sinks.land_chunks(rows.transform(op.with_schema_key), landed)
    name = plans.run_documents(spark, landed, target, "trusted_titles_typed")
    return sources.read_table(spark, name).select(
        "imdb_id",
        "Budget",
        "budget_2",
        F.col("rating.of").alias("rating_of"),
        F.element_at("votes", 2).alias("vote"),
        "genre_name",
        "company_name",
        "production_country_name",
        "spoken_language_name",
    )


@query
def compacted_documents(spark, d):
    """The trusted rows of documents whose small files have been put together."""
    landed, compacted, target = (work_dir(spark, n) for n in ("landed", "compacted", "trusted"))
    rows = _title_documents(spark, d).select("imdb_id", F.to_json(F.struct("*")).alias("payload"))
    sinks.land_chunks(rows.transform(op.with_schema_key), landed, compression="gzip")
    sinks.compact_documents(spark, landed, compacted, bin_bytes=1 << 20, compression="gzip")
    name = plans.run_documents(spark, compacted, target, "trusted_titles_compacted")
    return sources.read_table(spark, name).select(
        "imdb_id",
        F.col("budget").cast("string").alias("budget"),
        F.to_json("rating").alias("rating"),
        "genre_name",
        "company_name",
        "production_country_name",
        "spoken_language_name",
    )


@query
def compacted_records(spark, d):
    """Every landed record, fetched by its file and its number there from the compacted files."""
    landed, compacted = work_dir(spark, "landed"), work_dir(spark, "compacted")
    sinks.land_chunks(event_documents(spark, d).transform(op.with_schema_key), landed)
    sinks.compact_documents(spark, landed, compacted, bin_bytes=1 << 16)
    files = spark.read.parquet(f"{compacted}/{INDEX}")
    wanted = files.select("file", F.explode(F.sequence(F.lit(1), "records")).alias("record"))
    fetched = sinks.fetch_records(spark, compacted, wanted)
    return fetched.select("payload", (F.col("record") <= schemas.CHUNK_SIZE).alias("bounded"))


@query
def landed_schemas(spark, d):
    """The fields and types of each set of keys, as the landing has kept them."""
    path = work_dir(spark, "chunks")
    sinks.land_chunks(event_documents(spark, d).transform(op.with_schema_key), path)
    kept = sources.landed_schemas(spark, path)
    return kept.select("schema_id", "schema_key", F.inline("fields"))


@query
def landed_values(spark, d):
    """Values with blanks, separators, quotes and line breaks, through the landing job and back."""
    source, raw = work_dir(spark, "source"), work_dir(spark, "raw")
    orders = table(spark, d, "orders")
    rows = orders.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" |\"\n "), "o_orderstatus", F.lit("  ")).alias("note"),
    )
    sinks.land_by_date(rows, source, RUN_DATE, multi_line=True)
    plans.run_landing(spark, day_path(source, RUN_DATE), raw, RUN_DATE, multi_line=True)
    return sources.read_landed_day(spark, raw, RUN_DATE, multi_line=True)


@query
def unified_movies_bucketed(spark, d):
    """Local titles from a table in buckets by title, which is not shuffled."""
    local = trusted_local_movies(spark, d)
    name = sinks.save_table(
        local, schemas.TRUSTED_DATABASE, "titles_in_buckets", work_dir(spark, "buckets"), buckets=("imdb_id", 8)
    )
    return plans.unified_movies_rows(sources.read_place(spark, name), _trusted_batches(spark, d))


@query
def unified_movies_kept_up(spark, d):
    """The table after batches 1 and 2, then 3, each of which rewrites the parts it touches."""
    kept = plans.UnifiedMovies(spark, work_dir(spark, "kept"), "unified_movies_kept_up", parts=16)
    kept.start(trusted_local_movies(spark, d))
    first, second, third = _trusted_batches(spark, d)
    kept.add(op.union_batches([first, second]), 1)
    kept.add(third, 3)
    return kept.table()


@query
def series_job(spark, d):
    """The job of the refined series, from a stored trusted table to the catalog."""
    trusted, refined = work_dir(spark, "trusted"), work_dir(spark, "refined")
    trusted_local_series(spark, d).write.parquet(trusted)
    return sources.read_table(spark, plans.run_series(spark, trusted, refined))


@query
def unified_movies_job_documents(spark, d):
    """The job of the refined movies, straight from landed documents."""
    local, landed, refined = (work_dir(spark, n) for n in ("local", "landed", "refined"))
    trusted_local_movies(spark, d).write.parquet(local)
    folders = []
    for i, batch in enumerate(document_batches(spark, d)):
        docs = batch.select(F.to_json(F.struct("*")).alias("payload"))
        sinks.land_chunks(
            docs.transform(op.with_schema_key), f"{landed}/{i}", compression="gzip"
        )
        folders.append(f"{landed}/{i}")
    name = plans.run_unified_movies(
        spark, local, folders, refined, table="unified_movies_of_documents", documents=True
    )
    return sources.read_table(spark, name)


@query
def catalogued_lake(spark, d):
    """All jobs in turn through files and catalog tables, up to the refined table."""
    source, raw, trusted, refined = (work_dir(spark, n) for n in ("src", "raw", "trusted", "ref"))
    local_file(spark, d).write.options(header=True, sep="|").csv(source)
    plans.run_landing(spark, source, f"{raw}/movies", RUN_DATE)
    plans.run_local(
        spark,
        day_path(f"{raw}/movies", RUN_DATE),
        f"{trusted}/local",
        schemas.MOVIE_RENAMES,
        None,
        "trusted_local_movies",
    )
    batches = []
    for number, batch in enumerate(document_batches(spark, d), start=1):
        landed, target = f"{raw}/documents_{number}", f"{trusted}/documents_{number}"
        docs = batch.select(F.to_json(F.struct("*")).alias("payload"))
        sinks.land_chunks(docs.transform(op.with_schema_key), landed)
        plans.run_documents(spark, landed, target, f"trusted_api_movies_{number}")
        batches.append(target)
    name = plans.run_unified_movies(spark, f"{trusted}/local", batches, refined)
    return sources.read_table(spark, name)
