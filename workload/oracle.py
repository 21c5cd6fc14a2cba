"""Standard SQL for the queries of ``registry``, written for DuckDB."""

from __future__ import annotations

from workload.inputs import ARTIST

# --- The inputs of ``workload.inputs`` ---------------------------------------


def _local_file(series: bool = False) -> str:
    finish = "strftime(o_orderdate + INTERVAL 400 DAY, '%Y') AS finish_year," if series else ""
    return f"""
    SELECT 'tt' || o_orderkey AS imdb_id, 'Order ' || o_orderkey AS title,
           'Pedido ' || o_orderkey AS original_title,
           strftime(o_orderdate, '%Y') AS release_year, {finish}
           CASE WHEN o_orderstatus = 'P' THEN 'n/a'
                ELSE CAST(dayofyear(o_orderdate) AS VARCHAR) END AS runtime,
           replace(o_orderpriority, '-', ',') AS genre,
           CAST(dayofmonth(o_orderdate) AS VARCHAR) AS vote_average,
           CAST(o_custkey AS VARCHAR) AS vote_count,
           c_mktsegment AS artist_gender, o_orderpriority AS "character",
           c_name AS artist_name, CAST(c_nationkey AS VARCHAR) AS birth_year,
           CAST(NULL AS VARCHAR) AS death_year,
           c_mktsegment || ',' || o_orderstatus AS profession
    FROM orders JOIN customer ON o_custkey = c_custkey"""


def _trusted_local(where: str = "TRUE", series: bool = False) -> str:
    return f"""
    SELECT f.* REPLACE (g.item AS genre, p.item AS profession)
    FROM ({_local_file(series)}) f, unnest(string_split(f.genre, ',')) AS g(item),
         unnest(string_split(f.profession, ',')) AS p(item)
    WHERE {where}"""


_LINES = """
    SELECT * FROM lineitem
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey"""

# One row per document and company of it.
_COMPANIES = f"""
    SELECT l_returnflag AS batch, l_orderkey, l_linenumber, l_linestatus,
           s_suppkey AS company_id, s_name AS company_name, n_name AS company_origin_country
    FROM ({_LINES}) x
    UNION ALL
    SELECT l_returnflag, l_orderkey, l_linenumber, l_linestatus,
           CAST(n_nationkey AS BIGINT), n_name, r_name
    FROM ({_LINES}) x WHERE l_returnflag = 'R'"""


# One row per title and combination of the values its line items have.
_TITLE_DOCUMENTS = f"""
    WITH line AS (SELECT 'tt' || l_orderkey AS imdb_id, * FROM ({_LINES}) x),
    company AS (
        SELECT DISTINCT 'tt' || l_orderkey AS imdb_id, company_id, company_name,
               company_origin_country
        FROM ({_COMPANIES}) c)
    SELECT imdb_id,
           CASE WHEN l_orderkey % 2 = 1 THEN CAST(length(imdb_id) AS VARCHAR) END AS budget,
           CASE WHEN l_orderkey % 2 = 0 THEN '{{"of":"' || imdb_id || '"}}' END AS rating,
           genre_name, company_name, production_country_name, spoken_language_name
    FROM (SELECT DISTINCT imdb_id, l_orderkey FROM line) t
    JOIN (SELECT DISTINCT imdb_id, string_split(p_name, ' ')[1] AS genre_name FROM line) g
        USING (imdb_id)
    JOIN company USING (imdb_id)
    JOIN (SELECT DISTINCT imdb_id, r_name AS production_country_name
          FROM line WHERE l_linestatus = 'F') n USING (imdb_id)
    JOIN (SELECT DISTINCT imdb_id, 'status ' || l_linestatus AS spoken_language_name
          FROM line) v USING (imdb_id)"""


def _spelled(us: bool) -> str:
    return "CASE WHEN r_name = 'AMERICA' THEN 'US' ELSE r_name END" if us else "r_name"


_TRUSTED_DOCUMENTS = f"""
    SELECT 'tt' || x.l_orderkey AS imdb_id, p_name AS title, p_type AS homepage,
           p_brand AS overview, CAST(NULL AS VARCHAR) AS poster_path, '' AS tagline,
           TRUE AS video,
           w.i AS genre_id, string_split(p_name, ' ')[w.i + 1] AS genre_name,
           CASE c.n WHEN 1 THEN s_suppkey ELSE n_nationkey END AS company_id,
           CASE c.n WHEN 1 THEN s_name ELSE n_name END AS company_name,
           CASE c.n WHEN 1 THEN n_name ELSE r_name END AS company_origin_country,
           CAST(r_regionkey AS VARCHAR) AS production_country_iso_3166_1,
           {_spelled(True)} AS production_country_name,
           CASE v.n WHEN 1 THEN 'flag' ELSE 'status' END AS spoken_language_english_name,
           CASE v.n WHEN 1 THEN l_returnflag ELSE l_linestatus END AS spoken_language_iso_639_1,
           CASE v.n WHEN 1 THEN 'flag ' || l_returnflag
                ELSE 'status ' || l_linestatus END AS spoken_language_name
    FROM ({_LINES}) x, unnest(range(len(string_split(x.p_name, ' ')))) AS w(i)
    JOIN (VALUES (1), (2)) AS c(n) ON c.n = 1 OR l_returnflag = 'R',
    (VALUES (1), (2)) AS v(n)
    WHERE l_linestatus = 'F'"""


def _unified(
    local: str, us: bool = True, per_batch: bool = False, join: str = "JOIN"
) -> str:
    if per_batch:
        columns = ", ".join(f"o{i}.origin AS company_origin_country_{i}" for i in (1, 2, 3))
        origins = " ".join(
            f"""LEFT JOIN (SELECT DISTINCT company_name, company_origin_country AS origin
                FROM company WHERE batch = '{b}') o{i} ON o{i}.company_name = tc.company_name"""
            for i, b in enumerate("ANR", start=1)
        )
    else:
        columns = "o.company_origin_country"
        origins = """LEFT JOIN (SELECT DISTINCT company_name, company_origin_country FROM company
            WHERE company_origin_country IS NOT NULL) o ON o.company_name = tc.company_name"""
    return f"""
    WITH company AS (SELECT * FROM ({_COMPANIES}) x WHERE l_linestatus = 'F'),
    tc AS (SELECT DISTINCT 'tt' || l_orderkey AS imdb_id, company_name FROM company),
    country AS (SELECT DISTINCT 'tt' || l_orderkey AS imdb_id,
                       {_spelled(us)} AS production_country_name
                FROM ({_LINES}) x WHERE l_linestatus = 'F')
    SELECT DISTINCT t.imdb_id, original_title, release_year,
           TRY_CAST(runtime AS INTEGER) AS runtime, genre, vote_average, vote_count, profession,
           tc.company_name, {columns}, country.production_country_name
    FROM ({local}) t {join} tc ON t.imdb_id = tc.imdb_id {origins}
    {join} country ON t.imdb_id = country.imdb_id"""


# Fields that an event document has beside id and type.
_EVENT = """
    SELECT event_id AS id, event_type AS "type",
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_of_props, user_id
    FROM events"""
_EVENT_FIELDS = f"""
    SELECT id, "type",
           CASE WHEN "type" IN ('click', 'view') THEN k_of_props END AS k,
           CASE WHEN "type" = 'purchase' THEN user_id END AS buyer,
           CASE WHEN "type" = 'error' THEN 'code ' || k_of_props END AS code
    FROM ({_EVENT}) e"""
_EVENT_DOCUMENTS = f"""
    SELECT id, '{{"id":' || id || ',"type":"' || "type" || '"'
               || coalesce(',"k":' || k, '') || coalesce(',"buyer":' || buyer, '')
               || coalesce(',"code":"' || code || '"', '') || '}}' AS payload
    FROM ({_EVENT_FIELDS}) f"""
_EVENT_KEYS = f"""
    SELECT id, payload,
           CAST(to_json(list_sort(json_keys(CAST(payload AS JSON)))) AS VARCHAR) AS schema_key
    FROM ({_EVENT_DOCUMENTS}) d"""
_EVENT_POSITIONS = f"""
    SELECT *, row_number() OVER (PARTITION BY schema_key ORDER BY id) AS position
    FROM ({_EVENT_KEYS}) k"""
_EVENT_CHUNKS = f"SELECT *, (position - 1) // 100 + 1 AS chunk FROM ({_EVENT_POSITIONS}) p"
_ENCODED = f"""
    SELECT schema_key, chunk, '[' || string_agg(payload, ',' ORDER BY position) || ']' AS documents,
           count(*) AS records
    FROM ({_EVENT_CHUNKS}) c GROUP BY schema_key, chunk"""

_LOOKUPS = """
    SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'MACHINERY' THEN 404 ELSE 200 END AS status,
           CASE WHEN c_mktsegment = 'FURNITURE' THEN '{}'
                ELSE '{"id":' || c_custkey || ',"name":"' || c_name || '"'
                     || CASE WHEN c_mktsegment = 'BUILDING' THEN ',"nation":' || c_nationkey
                             ELSE '' END || '}' END AS payload
    FROM customer"""

# Suppliers of an order; a line item of batch N names none.
_ORDER_SUPPLIERS = """
    SELECT l_orderkey AS o_orderkey,
           CASE WHEN l_returnflag <> 'N' THEN s_name END AS supplier
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"""
_SUPPLIER_TEXT = f"""
    SELECT o_orderkey, coalesce(string_agg(DISTINCT supplier, ',' ORDER BY supplier), '')
           AS suppliers
    FROM ({_ORDER_SUPPLIERS}) s GROUP BY o_orderkey"""
_SUPPLIER_PAIRS = f"SELECT DISTINCT * FROM ({_ORDER_SUPPLIERS}) s WHERE supplier IS NOT NULL"

# --- One statement per query -------------------------------------------------

_REFINED_SERIES = f"""
        SELECT imdb_id, original_title, release_year, finish_year,
               TRY_CAST(runtime AS INTEGER) AS runtime, genre, vote_average, vote_count, profession
        FROM ({_trusted_local(series=True)}) t"""

ORACLE: dict[str, str] = {
    "scan_delimited": """
        SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
               CAST(c_acctbal AS VARCHAR) AS balance,
               nullif(c_mktsegment, 'MACHINERY') AS segment FROM customer""",
    "scan_delimited_with_bad_rows": """
        SELECT c_custkey % 3 = 0 AS bad, CAST(c_custkey AS VARCHAR) AS id,
               CASE c_custkey % 6 WHEN 0 THEN c_custkey || '|' || c_name || '|' || c_mktsegment || '|one more'
                    WHEN 3 THEN c_custkey || '|' || c_name ELSE c_name END AS name,
               CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS segment
        FROM customer""",
    "scan_json_arrays": _EVENT_FIELDS,
    "scan_json_lines": _EVENT_FIELDS,
    "scan_parquet": "SELECT l_orderkey, l_suppkey FROM lineitem",
    "read_objects": f"SELECT documents AS content FROM ({_ENCODED}) e",
    "files_by_size": "SELECT count(*) AS rows, TRUE AS in_band FROM lineitem",
    "save_table": "SELECT p_partkey, p_brand, p_size FROM part",
    "land_by_date": """
        SELECT event_id, event_type, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
               strftime(ts, '%d') AS day FROM events
        UNION ALL SELECT event_id, event_type, '2023', '11', '06' FROM events""",
    "land_chunks": f"""
        SELECT md5(schema_key) AS schema_id, count(*) AS records, TRUE AS bounded
        FROM ({_EVENT_KEYS}) k GROUP BY schema_key""",
    "drop_and_rename": """
        SELECT c_custkey AS id, c_name AS name, c_nationkey, c_mktsegment AS segment
        FROM customer""",
    "project_key": "SELECT user_id FROM events",
    "keep_equal": "SELECT * FROM part WHERE p_brand = 'Brand#13'",
    "cast_text_to_int": """
        SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN NULL
                               ELSE CAST(trunc(p_retailprice) AS INTEGER) END AS runtime
        FROM part""",
    "canonicalise": """
        SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'CAR' WHEN 'MACHINERY' THEN NULL
                                            ELSE c_mktsegment END AS segment
        FROM customer""",
    "canonicalise_from": """
        SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS country
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "found_lookups": f"SELECT * FROM ({_LOOKUPS}) l WHERE status = 200 AND payload <> '{{}}'",
    "failed_lookups": f"SELECT * FROM ({_LOOKUPS}) l WHERE status <> 200 OR payload = '{{}}'",
    "date_parts": """
        SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year,
               strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day
        FROM orders""",
    "format_path": """
        SELECT o_orderkey, strftime(o_orderdate, 'raw/orders/%Y/%m/%d/orders.csv') AS path
        FROM orders""",
    "explode_text": "SELECT p_partkey, unnest(string_split(p_name, ' ')) AS genre FROM part",
    "explode_two_texts": """
        SELECT p_partkey, g.item AS genre, p.item AS profession
        FROM part, unnest(string_split(p_name, ' ')) AS g(item),
             unnest([p_brand, p_type]) AS p(item)""",
    "explode_structs": f"""
        SELECT 'tt' || l_orderkey AS imdb_id, CAST(l_linenumber AS BIGINT) AS id,
               company_id, company_name, company_origin_country FROM ({_COMPANIES}) c""",
    "explode_structs_outer": f"""
        SELECT 'tt' || l_orderkey AS imdb_id, CAST(l_linenumber AS BIGINT) AS id,
               CASE l_linestatus WHEN 'F' THEN CAST(r_regionkey AS VARCHAR) END
                   AS production_country_iso_3166_1,
               CASE l_linestatus WHEN 'F' THEN r_name END AS production_country_name
        FROM ({_LINES}) x""",
    "collect_companies": _SUPPLIER_TEXT,
    "companies_in_segments": f"SELECT *, TRUE AS bounded FROM ({_SUPPLIER_TEXT}) s",
    "collect_countries": f"""
        SELECT 'tt' || l_orderkey AS imdb_id,
               coalesce(string_agg(DISTINCT country, ',' ORDER BY country), '') AS countries
        FROM (SELECT l_orderkey, CASE WHEN l_linestatus = 'F' THEN r_name END AS country
              FROM ({_LINES}) x) c
        GROUP BY l_orderkey""",
    "known_pairs": _SUPPLIER_PAIRS,
    "attach_column": f"""
        SELECT o_orderkey, o_orderstatus, suppliers
        FROM orders LEFT JOIN ({_SUPPLIER_TEXT}) s USING (o_orderkey)""",
    "attach_and_explode": f"""
        SELECT o_orderkey, o_orderstatus, supplier
        FROM orders JOIN ({_SUPPLIER_PAIRS}) s USING (o_orderkey)""",
    "attach_and_explode_kept": f"""
        SELECT o_orderkey, o_orderstatus, supplier
        FROM orders LEFT JOIN ({_SUPPLIER_PAIRS}) s USING (o_orderkey)""",
    "values_by_batch": """
        WITH status AS (SELECT DISTINCT l_returnflag, p_brand, l_linestatus
                        FROM lineitem JOIN part ON l_partkey = p_partkey)
        SELECT p_partkey, part.p_brand, a.l_linestatus AS status_1, n.l_linestatus AS status_2,
               r.l_linestatus AS status_3
        FROM part
        LEFT JOIN status a ON a.p_brand = part.p_brand AND a.l_returnflag = 'A'
        LEFT JOIN status n ON n.p_brand = part.p_brand AND n.l_returnflag = 'N'
        LEFT JOIN status r ON r.p_brand = part.p_brand AND r.l_returnflag = 'R'""",
    "union_batches": """
        SELECT l_orderkey, l_suppkey, l_returnflag FROM lineitem WHERE l_returnflag = 'A'
        UNION ALL
        SELECT l_orderkey, l_suppkey, l_returnflag FROM lineitem WHERE l_returnflag = 'N'
        UNION ALL
        SELECT l_orderkey, l_suppkey, l_returnflag FROM lineitem WHERE l_returnflag = 'R'""",
    "distinct_rows": "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem",
    "sql_over_named_frames": """
        SELECT DISTINCT o_orderkey, o_custkey, c_mktsegment
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "sql_over_temp_views": "SELECT l_orderkey, l_suppkey, l_returnflag FROM lineitem",
    "enrich": f"""
        SELECT l.* FROM events JOIN ({_LOOKUPS}) l ON user_id = l.id""",
    "enrich_counted": f"""
        SELECT l.*, copies FROM ({_LOOKUPS}) l
        JOIN (SELECT user_id, count(*) AS copies FROM events GROUP BY user_id) k
        ON l.id = user_id""",
    "enrich_filtered": f"""
        SELECT l.*, copies FROM ({_LOOKUPS}) l
        JOIN (SELECT user_id, count(*) AS copies FROM events GROUP BY user_id) k
        ON l.id = user_id""",
    "count_keys": "SELECT user_id AS id, count(*) AS copies FROM events GROUP BY user_id",
    "chunk_copies": f"""
        SELECT status, id, (row_number() OVER (PARTITION BY status ORDER BY id) - 1) // 100 + 1
               AS chunk
        FROM events JOIN ({_LOOKUPS}) l ON user_id = l.id""",
    "unknown_keys": """
        SELECT c_custkey AS id FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
    "schema_keys": f"SELECT id, schema_key FROM ({_EVENT_KEYS}) k",
    "schema_groups": f"""
        SELECT schema_key, count(*) AS documents FROM ({_EVENT_KEYS}) k GROUP BY schema_key""",
    "chunk_within": f"SELECT id, schema_key, position, chunk FROM ({_EVENT_CHUNKS}) c",
    "decode_json": _EVENT_FIELDS,
    "encode_chunks": _ENCODED,
    "landed_file": f"""
        SELECT imdb_id AS id, title AS "tituloPincipal", original_title AS "tituloOriginal",
               release_year AS "anoLancamento", runtime AS "tempoMinutos", genre AS genero,
               vote_average AS "notaMedia", vote_count AS "numeroVotos",
               artist_gender AS "generoArtista", "character" AS personagem,
               artist_name AS "nomeArtista", birth_year AS "anoNascimento",
               death_year AS "anoFalecimento", profession AS profissao,
               "character" AS "titulosMaisConhecidos"
        FROM ({_local_file()}) f""",
    "landed_lookups": """
        SELECT c_custkey AS id, c_name AS name,
               CASE WHEN c_mktsegment = 'BUILDING' THEN c_nationkey END AS nation
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderstatus = 'F' AND c_mktsegment NOT IN ('MACHINERY', 'FURNITURE')""",
    "landed_lookup_arrays": f"""
        SELECT CAST(chunk AS VARCHAR) AS chunk,
               '[' || string_agg(payload, ',' ORDER BY position) || ']' AS content
        FROM (SELECT *, (position - 1) // 100 + 1 AS chunk
              FROM (SELECT payload, payload LIKE '%"nation"%' AS fields,
                           row_number() OVER (PARTITION BY payload LIKE '%"nation"%'
                                              ORDER BY CAST(l.id AS VARCHAR)) AS position
                    FROM orders JOIN ({_LOOKUPS}) l ON o_custkey = l.id
                    WHERE o_orderstatus = 'F' AND status = 200 AND payload <> '{{}}') p) c
        GROUP BY fields, chunk""",
    "trusted_local_movies": _trusted_local(),
    "trusted_local_movies_of_artist": _trusted_local(f"artist_name = '{ARTIST}'"),
    "trusted_local_series": _trusted_local(series=True),
    "trusted_documents": _TRUSTED_DOCUMENTS,
    "trusted_documents_in_blocks": _TRUSTED_DOCUMENTS,
    "refined_series": _REFINED_SERIES,
    "series_job": _REFINED_SERIES,
    "unified_movies": _unified(_trusted_local()),
    "unified_movies_bucketed": _unified(_trusted_local()),
    "unified_movies_kept_up": _unified(_trusted_local()),
    "unified_movies_of_artist": _unified(_trusted_local(f"artist_name = '{ARTIST}'")),
    "unified_movies_origin_per_batch": _unified(_trusted_local(), per_batch=True),
    "unified_movies_keep_unmatched": _unified(_trusted_local(), join="LEFT JOIN"),
    "unified_movies_from_documents": _unified(_trusted_local()),
    "unified_movies_job_documents": _unified(_trusted_local(), us=False),
    "trusted_documents_landed": _TITLE_DOCUMENTS,
    "trusted_documents_landed_arrays": _TITLE_DOCUMENTS,
    "trusted_documents_typed": f"""
        SELECT imdb_id,
               CASE WHEN rating IS NOT NULL THEN CAST(length(imdb_id) + 0.5 AS DOUBLE) END AS "Budget",
               CASE WHEN rating IS NULL THEN length(imdb_id) END AS budget_2,
               CASE WHEN rating IS NOT NULL THEN imdb_id END AS rating_of,
               CASE WHEN rating IS NULL THEN length(imdb_id) + 1 END AS vote,
               genre_name, company_name, production_country_name, spoken_language_name
        FROM ({_TITLE_DOCUMENTS}) t""",
    "compacted_documents": _TITLE_DOCUMENTS,
    "compacted_records": f"SELECT payload, TRUE AS bounded FROM ({_EVENT_KEYS}) k",
    "landed_schemas": f"""
        SELECT DISTINCT md5(schema_key) AS schema_id, schema_key, name,
               CASE WHEN name IN ('type', 'code') THEN 'string' ELSE 'bigint' END AS type
        FROM ({_EVENT_KEYS}) k, unnest(json_keys(CAST(payload AS JSON))) AS f(name)""",
    "landed_values": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               '  ' || o_orderpriority || ' |"' || chr(10) || ' ' || o_orderstatus || '  ' AS note
        FROM orders""",
    "catalogued_lake": _unified(_trusted_local(), us=False),
}
