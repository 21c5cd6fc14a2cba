"""The SQL of those queries that SQL can express on whole tables."""

ORACLE: dict[str, str] = {}

ORACLE["op1_warc"] = """
WITH hashed AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), first AS (
    SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM hashed
)
SELECT
    page_id,
    CAST(strlen(payload) AS BIGINT) AS payload_bytes,
    @base32@ AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM first
""".replace(
    "@base32@",
    " || ".join(
        f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
        f"1 + ((CAST('0x' || substr(hex, {5 * i + 1}, 5) AS INT) >> {shift}) & 31), 1)"
        for i in range(8)
        for shift in (15, 10, 5, 0)
    ),
)

ORACLE["op3_line_dedup"] = """
WITH cut AS (
    SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
    SELECT doc_id, unnest(range(1, len(lines) + 1)) AS i, unnest(lines) AS line, len(lines) AS n
    FROM cut
), near AS (
    SELECT *,
        lag(md5(line)) OVER (PARTITION BY doc_id ORDER BY i) AS before,
        lead(length(line)) OVER (PARTITION BY doc_id ORDER BY i) AS next_length
    FROM line
), rolling AS (
    SELECT *, substr(md5(coalesce(before, '') || md5(line)), 1, 1) IN ('0', '1', '2', '3') AS rolled
    FROM near
), ending AS (
    SELECT *, CAST(
        i = n OR length(line) >= 120 OR coalesce(next_length >= 120, false)
        OR (rolled AND NOT coalesce(lag(rolled) OVER (PARTITION BY doc_id ORDER BY i), false))
    AS INT) AS is_end
    FROM rolling
), numbered AS (
    SELECT *, sum(is_end) OVER (PARTITION BY doc_id ORDER BY i) - is_end AS chunk FROM ending
), chunk AS (
    SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS lines
    FROM numbered GROUP BY ALL
), marked AS (
    SELECT *, (lines > 1 AND trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> '')
        OR length(text) >= 120 AS may_go
    FROM chunk
), placed AS (
    SELECT *, may_go AND row_number() OVER (
        PARTITION BY may_go, text ORDER BY doc_id, chunk) > 1 AS goes
    FROM marked
)
SELECT
    doc_id,
    coalesce(string_agg(text, chr(10) ORDER BY chunk) FILTER (NOT goes), '') AS text,
    CAST(count(*) AS INT) AS n_chunks,
    CAST(count(*) FILTER (goes) AS INT) AS removed_chunks,
    CAST(coalesce(sum(lines) FILTER (goes), 0) AS INT) AS removed_lines
FROM placed GROUP BY doc_id
"""

ORACLE["op6_decontamination"] = """
WITH unit AS (
    SELECT 0 AS kind, doc_id AS id, text FROM documents
    UNION ALL SELECT 1, item_id, text FROM benchmark
), word AS (
    SELECT kind, id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[a-z0-9\\x{80}-\\x{10FFFF}]+') AS words
    FROM unit
), shingle AS (
    SELECT DISTINCT kind, id, words[i : i + 4] AS shingle
    FROM (SELECT *, unnest(range(1, len(words) - 3)) AS i FROM word WHERE len(words) >= 5)
), size AS (
    SELECT id AS item_id, count(*) AS n_shingles FROM shingle WHERE kind = 1 GROUP BY id
), shared AS (
    SELECT d.id AS doc_id, b.id AS item_id, count(*) AS shared
    FROM shingle d JOIN shingle b USING (shingle) WHERE d.kind = 0 AND b.kind = 1
    GROUP BY ALL
)
SELECT doc_id, item_id, n_shingles, shared, shared / n_shingles AS containment
FROM shared JOIN size USING (item_id)
WHERE shared >= 0.8 * n_shingles
"""

ORACLE["op9_minhash_near_dedup"] = """
WITH RECURSIVE word AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x20\\x09-\\x0D]+') AS words
    FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, words[i : i + 2] AS shingle
    FROM (SELECT *, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM word WHERE len(words) > 0)
), size AS (
    SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
    FROM shingle a JOIN shingle b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY ALL
), link AS (
    SELECT a, b FROM shared
    JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
    WHERE 100 * common >= 85 * (x.n + y.n - common)
), reach AS (
    SELECT doc_id, doc_id AS other FROM word
    UNION
    SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other
), component AS (
    SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM component LEFT JOIN size USING (doc_id)
"""

ORACLE["op11_hard_negatives"] = """
WITH part AS (
    SELECT
        vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), score AS (
    SELECT
        a.vec_id AS anchor_id,
        b.vec_id,
        a.label = b.label AS same,
        CAST(coalesce(list_sum(list_transform(list_zip(a.vector, b.vector), lambda z: z[1] * z[2])), 0)
            AS BIGINT) AS score
    FROM part a JOIN part b ON a.vec_id % 100 = 0
), positive AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM score
    WHERE same AND vec_id <> anchor_id
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT
    anchor_id,
    positive_id,
    CAST(row_number() OVER (
        PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id,
    positive_score,
    score AS negative_score
FROM positive JOIN score USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _leaf(text: str) -> str:
    fields = [f"CAST({c} AS VARCHAR)" for c in ("doc_id", "source", "lang", "n_chars")] + [text]
    parts = [f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields]
    return f"sha256({' || '.join(parts)})"


def _tree(nodes: str, tree: str, levels: int) -> str:
    """Levels of the trees over ``<nodes>0`` (the tree, p, h, n), as further tables."""
    return ", ".join(
        f"""{nodes}{i + 1} AS (
    SELECT {tree}, p // 16 AS p, sha256(string_agg(h, '' ORDER BY p)) AS h, (n + 15) // 16 AS n
    FROM {nodes}{i} WHERE n > 1 GROUP BY {tree}, p // 16, n
)"""
        for i in range(levels)
    )


def _proof(nodes: str, tree: str, levels: int, place: str) -> str:
    """What stands left and right of every row's ancestors, for each level."""
    return ", ".join(
        f"""{nodes}_step{i} AS (
    SELECT r.row_id,
        coalesce(string_agg(x.h, '' ORDER BY x.p) FILTER (x.p < r.{place} // {16**i}), '') AS l,
        coalesce(string_agg(x.h, '' ORDER BY x.p) FILTER (x.p > r.{place} // {16**i}), '') AS r
    FROM whole r JOIN {nodes}{i} x
        ON x.{tree} IS NOT DISTINCT FROM r.{tree} AND x.n > 1 AND x.p // 16 = r.{place} // {16 ** (i + 1)}
    GROUP BY r.row_id
)"""
        for i in range(levels)
    )


def _folds(steps: list[str]) -> str:
    """One table after the other, each with the steps of one more level folded in."""
    out = []
    before = "whole"
    for i, step in enumerate(steps):
        out.append(
            f"""fold{i} AS (
    SELECT b.* REPLACE (
        CASE WHEN s.row_id IS NULL THEN b.folded ELSE sha256(s.l || b.folded || s.r) END AS folded,
        b.siblings || coalesce(s.l || s.r, '') AS siblings)
    FROM {before} b LEFT JOIN {step} s USING (row_id)
)"""
        )
        before = f"fold{i}"
    return ", ".join(out)


_DOC_LEVELS, _SOURCE_LEVELS = 6, 3
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT),
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

ORACLE["op12_merkle_manifest"] = f"""
WITH base AS (
    SELECT doc_id, source, {_leaf("text")} AS leaf,
        CASE WHEN {_CRC32} % 5 = 0
            THEN {_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} END AS other
    FROM documents
), doc AS (
    SELECT *, row_number() OVER () AS row_id,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
        count(*) OVER (PARTITION BY source) AS n
    FROM base
), d0 AS (SELECT source, p, leaf AS h, n FROM doc),
{_tree("d", "source", _DOC_LEVELS)}
, top AS ({" UNION ALL ".join(f"SELECT source, h FROM d{i} WHERE n = 1" for i in range(_DOC_LEVELS + 1))}
), t0 AS (
    SELECT 1 AS forest, source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS p, h,
        count(*) OVER () AS n
    FROM top
), {_tree("t", "forest", _SOURCE_LEVELS)}
, root AS ({" UNION ALL ".join(f"SELECT h FROM t{i} WHERE n = 1" for i in range(_SOURCE_LEVELS + 1))}
), whole AS (
    SELECT d.doc_id, d.source, d.leaf, d.row_id, d.p AS place, t.p AS source_place, 1 AS forest,
        t.h AS subroot, root.h AS root, coalesce(d.other, d.leaf) AS folded, '' AS siblings
    FROM doc d JOIN t0 t ON t.source IS NOT DISTINCT FROM d.source, root
), {_proof("d", "source", _DOC_LEVELS, "place")}
, {_proof("t", "forest", _SOURCE_LEVELS, "source_place")}
, {_folds([f"d_step{i}" for i in range(_DOC_LEVELS)] + [f"t_step{i}" for i in range(_SOURCE_LEVELS)])}
SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, folded AS folded_root,
    folded = root AS verified
FROM fold{_DOC_LEVELS + _SOURCE_LEVELS - 1}
"""
