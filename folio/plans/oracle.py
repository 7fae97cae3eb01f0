"""DuckDB oracle SQL for the registered queries (independent of the Spark code:
listing oracles compute records from ``part`` with the render rule, never from HTML)."""

from __future__ import annotations

from folio.sources.render import PAGE_ROOT, ROWS_PER_PAGE

# Python str.isspace characters, spelled out (DuckDB's \s is ASCII only).
_WS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _repr(x: str) -> str:
    return (f"(CASE WHEN contains({x}, '''') AND NOT contains({x}, '\"') THEN '\"' || replace({x}, '\\', '\\\\') || '\"' "
            f"ELSE '''' || replace(replace({x}, '\\', '\\\\'), '''', '\\''') || '''' END)")


def _pick(idx: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE {idx} {whens} END)"


_LISTING_CTE = f"""
p AS (
  SELECT p_partkey AS k, p_size AS s, p_type AS t, p_brand AS b, p_partkey // {ROWS_PER_PAGE} AS block,
         (p_partkey // {ROWS_PER_PAGE}) % 7 AS ti,
         row_number() OVER (PARTITION BY p_partkey // {ROWS_PER_PAGE} ORDER BY p_partkey) AS row_pos,
         p_partkey % 29 = 7 AS empty_row, p_partkey % 11 = 3 AS no_class
  FROM part),
q AS (
  SELECT *, (k % 97 = 50 AND NOT empty_row AND NOT no_class) AS bad,
         {_pick('ti', ['DoDD/', 'dodi/', 'dodm/', 'inst/', 'dtm/', '140025/', 'dodd'])} AS suffix,
         {_pick('ti', ['DoDD', 'DoDI', 'DoDM', 'AI', 'DTM', 'DoDI', 'DoDI'])} AS prefix,
         {_pick('ti', ['DoDD', 'DoDI', 'DoDM', 'AI', 'DTM', 'DoDI CPM', 'DoDI CPM'])} AS doc_type
  FROM p),
fb AS (SELECT block, min(row_pos) AS first_bad FROM q WHERE bad GROUP BY block),
r AS (
  SELECT q.*, CASE WHEN s % 5 = 0 THEN ' CH ' || (s // 5)::VARCHAR ELSE '' END AS chg,
    CASE WHEN s % 5 = 0 THEN (s % 12 + 1)::VARCHAR || '/' || (s % 28 + 1)::VARCHAR || '/2019' ELSE '' END AS chg_date,
    CASE WHEN ti = 4 THEN 'DTM-' || lpad(s::VARCHAR, 2, '0') || '-' || lpad(((s * 13) % 1000)::VARCHAR, 3, '0')
         WHEN ti = 5 AND k % 2 = 0 THEN 'DoDI 1400.25 Volume ' || s::VARCHAR
         WHEN ti = 5 THEN 'DoDI 1400.25'
         WHEN k % 13 = 5 THEN prefix || '-' || s::VARCHAR
         ELSE prefix || ' ' || s::VARCHAR || '.' || lpad((s % 7)::VARCHAR, 2, '0') END AS base_name,
    CASE WHEN ti = 4 THEN lpad(s::VARCHAR, 2, '0') || '-' || lpad(((s * 13) % 1000)::VARCHAR, 3, '0')
         WHEN ti = 5 AND k % 2 = 0 THEN s::VARCHAR
         WHEN ti = 5 THEN '1400.25'
         WHEN k % 13 = 5 THEN s::VARCHAR
         ELSE s::VARCHAR || '.' || lpad((s % 7)::VARCHAR, 2, '0') END AS num,
    CASE WHEN k % 19 = 0 THEN '"' || t || '"' ELSE t END || CASE WHEN k % 17 = 0 THEN ' FOUO' ELSE '' END AS raw_title,
    'https://www.esd.whs.mil/Portals/54/Documents/' || lower(prefix) || '/' || s::VARCHAR || '%20'
      || replace(lower(t), ' ', '%20') || CASE WHEN k % 23 = 0 THEN '.PDF?ver=2' ELSE '.pdf' END AS url
  FROM q LEFT JOIN fb USING (block)
  WHERE NOT no_class AND (first_bad IS NULL OR row_pos < first_bad)),
rec AS (
  SELECT '{PAGE_ROOT}' || block::VARCHAR || '/' || suffix AS source_page_url, row_pos::INTEGER AS row_pos,
    CASE WHEN empty_row THEN '' ELSE base_name || chg END AS doc_name,
    CASE WHEN empty_row THEN '' ELSE num END AS doc_num,
    CASE WHEN empty_row THEN '' ELSE replace(raw_title, '"', '') END AS doc_title,
    doc_type,
    CASE doc_type WHEN 'DoDD' THEN 'Directive' WHEN 'DoDI' THEN 'Instruction' WHEN 'DoDM' THEN 'Manual'
      WHEN 'AI' THEN 'Instruction' WHEN 'DTM' THEN 'Memorandum' ELSE 'Document' END AS display_doc_type,
    '' AS publication_date,
    (NOT empty_row AND (contains(url, 'CAC') OR contains(url, 'PKI certificate required') OR contains(url, 'placeholder')
      OR contains(url, 'FOUO') OR contains(raw_title, 'CAC') OR contains(raw_title, 'PKI certificate required')
      OR contains(raw_title, 'placeholder') OR contains(raw_title, 'FOUO'))) AS cac_login_required,
    CASE WHEN empty_row THEN '' ELSE url END AS download_url,
    CASE WHEN empty_row THEN 'Unkown' ELSE 'pdf' END AS file_ext,
    'www.esd.whs.mil' AS source_fqdn,
    CASE WHEN empty_row THEN '' ELSE chg_date END AS change_date, k, s, b, block, empty_row
  FROM r),
rec2 AS (SELECT *, doc_type || ' ' || doc_num || ': ' || doc_title AS display_title FROM rec),
listing AS (
  SELECT *, sha256('(''change_date'', ' || {_repr('change_date')} || ')(''display_title'', ' || {_repr('display_title')}
    || ')(''doc_name'', ' || {_repr('doc_name')} || ')(''doc_num'', ' || {_repr('doc_num')}
    || ')(''download_url'', ' || {_repr('download_url')} || ')(''pub_date'', '''')') AS version_hash
  FROM rec2),
store AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY version_hash ORDER BY source_page_url, row_pos) AS rn
                 FROM listing) WHERE rn = 1)
"""

# Inner tables' rows count as rows of the page, after the row that holds them.
_MALFORMED_CTE = _LISTING_CTE.replace(
    "row_number() OVER (PARTITION BY p_partkey // {0} ORDER BY p_partkey) AS row_pos".format(ROWS_PER_PAGE),
    "row_number() OVER w + sum(CASE WHEN p_partkey % 5 = 2 AND p_partkey % 29 <> 7 THEN 1 ELSE 0 END) OVER w "
    "- CASE WHEN p_partkey % 5 = 2 AND p_partkey % 29 <> 7 THEN 1 ELSE 0 END AS row_pos").replace(
    "  FROM part),", "  FROM part WINDOW w AS (PARTITION BY p_partkey // {0} ORDER BY p_partkey)),".format(ROWS_PER_PAGE))

LISTING_COLS = ("source_page_url, row_pos, doc_name, doc_num, doc_title, doc_type, display_doc_type, publication_date, "
                "cac_login_required, download_url, file_ext, source_fqdn, display_title, version_hash")


def _with_listing(select: str) -> str:
    return "WITH " + _LISTING_CTE + select


_CHUNK_CTE = f"""
RECURSIVE pcs AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY o) AS i, piece, length(piece) AS len,
         count(*) OVER (PARTITION BY doc_id) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS piece, unnest(range(len(string_split(text, chr(10))))) AS o
        FROM documents)
  WHERE piece <> ''),
walk AS (
  SELECT doc_id, 1 AS i, 0 AS chunk_no, piece AS cur, len AS total, NULL::VARCHAR AS emitted, n
  FROM pcs WHERE i = 1
  UNION ALL
  SELECT w.doc_id, w.i + 1,
    CASE WHEN w.total + x.len + 1 > 1000 THEN w.chunk_no + 1 ELSE w.chunk_no END,
    CASE WHEN w.total + x.len + 1 > 1000 THEN x.piece ELSE w.cur || chr(10) || x.piece END,
    CASE WHEN w.total + x.len + 1 > 1000 THEN x.len ELSE w.total + x.len + 1 END,
    CASE WHEN w.total + x.len + 1 > 1000 THEN w.cur ELSE NULL END,
    w.n
  FROM walk w JOIN pcs x ON x.doc_id = w.doc_id AND x.i = w.i + 1),
raw_chunks AS (
  SELECT doc_id, chunk_no - 1 AS k, emitted AS chunk FROM walk WHERE emitted IS NOT NULL
  UNION ALL
  SELECT doc_id, chunk_no AS k, cur AS chunk FROM walk WHERE i = n),
chunks AS (
  SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1)::INTEGER AS chunk_pos, chunk
  FROM (SELECT doc_id, k, {_strip('chunk')} AS chunk FROM raw_chunks) WHERE chunk <> '')
"""


# Chunks of 1000 with an overlap of 200: a new chunk begins with the longest run of last pieces of the old one that fits.
_OVERLAP_CTE = f"""
RECURSIVE pcs AS (
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY o) AS i, piece, length(piece) AS len,
         count(*) OVER (PARTITION BY doc_id) AS n
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS piece, unnest(range(len(string_split(text, chr(10))))) AS o
        FROM documents)
  WHERE piece <> ''),
walk AS (
  SELECT doc_id, 1 AS i, 0 AS chunk_no, [piece] AS cur, NULL::VARCHAR AS emitted, n FROM pcs WHERE i = 1
  UNION ALL
  SELECT doc_id, i, CASE WHEN over THEN chunk_no + 1 ELSE chunk_no END,
    list_append(CASE WHEN over THEN cur[list_min(list_filter(range(0, len(cur) + 1), lambda k:
        length(array_to_string(cur[k + 1:], chr(10))) <= 200 AND (k = len(cur) OR length(array_to_string(cur[k + 1:], chr(10))) + 1 + len <= 1000
        ))) + 1:] ELSE cur END, piece),
    CASE WHEN over THEN array_to_string(cur, chr(10)) ELSE NULL END, n
  FROM (SELECT w.doc_id, x.i, w.chunk_no, w.cur, w.n, x.piece, x.len, length(array_to_string(w.cur, chr(10))) + 1 + x.len > 1000 AS over
        FROM walk w JOIN pcs x ON x.doc_id = w.doc_id AND x.i = w.i + 1)),
raw_chunks AS (
  SELECT doc_id, chunk_no - 1 AS k, emitted AS chunk FROM walk WHERE emitted IS NOT NULL
  UNION ALL
  SELECT doc_id, chunk_no AS k, array_to_string(cur, chr(10)) AS chunk FROM walk WHERE i = n),
chunks AS (
  SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1)::INTEGER AS chunk_pos, chunk
  FROM (SELECT doc_id, k, {_strip('chunk')} AS chunk FROM raw_chunks) WHERE chunk <> '')
"""


def _with_chunks(select: str) -> str:
    return "WITH " + _CHUNK_CTE + select


def _embed_cte(table: str, key: str, text: str, name: str) -> str:
    sums = ", ".join(f"coalesce(sum(sgn) FILTER (WHERE bucket = {i}), 0)::DOUBLE" for i in range(64))
    return f"""
{name}_tok AS (SELECT {key} AS key, md5(tok) AS m FROM (
    SELECT {key}, unnest(list_filter(string_split(lower(replace({text}, chr(10), ' ')), ' '), lambda x: x <> '')) AS tok
    FROM {table})),
{name}_b AS (SELECT key, (('0x' || substr(m, 1, 8))::BIGINT % 64) AS bucket,
             CASE WHEN substr(m, 9, 1) < '8' THEN 1 ELSE -1 END AS sgn FROM {name}_tok),
{name}_raw AS (SELECT t.{key} AS key, [{sums}] AS v FROM {table} t LEFT JOIN {name}_b b ON b.key = t.{key} GROUP BY t.{key}),
{name} AS (SELECT key, CASE WHEN list_sum(list_transform(v, lambda x: x * x)) > 0
             THEN list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) ELSE v END AS vec
           FROM {name}_raw)
"""


def _knn_sql(qcte: str, qname: str) -> str:
    return f"""WITH {qcte},
d AS (SELECT q.key AS query_id, e.vec_id AS id,
        list_sum(list_transform(range(1, 65), lambda i: (q.vec[i] - e.embedding[i]::DOUBLE) * (q.vec[i] - e.embedding[i]::DOUBLE))) AS d2
      FROM {qname} q CROSS JOIN embeddings e),
s AS (SELECT query_id, id, 1.0 / (1.0 + d2) AS score FROM d),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank, id, score FROM s)
SELECT query_id::BIGINT AS query_id, rank::INTEGER AS rank, id, round(score, 9) AS score FROM r WHERE rank <= 2"""


def _escaped(path: str) -> str:
    """UTF-8 escapes of a path; these links have neither escapes nor arguments of their own."""
    out = f"url_encode({path})"
    for c in "!$&'()*+,;=:@/":
        out = f"replace({out}, '%{ord(c):02X}', '{c * (2 if c == chr(39) else 1)}')"
    return out


_LINKS_CTE = r"""
a AS (SELECT page_id, url, regexp_extract_all(regexp_extract(html, '(?is)<nav\b[^>]*>(.*?)</nav\s*>', 1),
        '(?is)<a\b([^>]*)>', 1) AS attrs FROM pages),
b AS (SELECT page_id, url, attrs, generate_subscripts(attrs, 1) AS i FROM a),
links AS (
  SELECT page_id, (i - 1)::INTEGER AS link_pos, regexp_extract(attrs[i], 'href\s*=\s*"([^"]*)"', 1) AS href,
         regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)
           || regexp_extract(attrs[i], 'href\s*=\s*"([^"]*)"', 1) AS link
  FROM b WHERE i - 1 >= 4 AND i - 1 < len(attrs) - 1 AND regexp_matches(attrs[i], '(?i)(^|\s)href\s*='))
"""


def oracle_sql() -> dict[str, str]:
    q_embed = _embed_cte("(SELECT 0::BIGINT AS query_id, 'which report tells of the river and the bridge' AS text)",
                         "query_id", "text", "qv")
    b_embed = _embed_cte("benchmark", "item_id", "text", "qv")
    return {
        "scan_pages": "SELECT page_id, url, html FROM pages",
        "scan_documents": "SELECT doc_id, text, lang, source FROM documents",
        "extract_listing": _with_listing(f"SELECT {LISTING_COLS} FROM listing"),
        "extract_malformed": "WITH " + _MALFORMED_CTE + f"SELECT {LISTING_COLS} FROM listing",
        "first_wins": _with_listing("SELECT version_hash, source_page_url, row_pos, doc_name FROM store"),
        "insert_if_absent": _with_listing(
            "SELECT version_hash AS _id, true AS _needs_download, source_page_url, row_pos, doc_name, download_url "
            "FROM (SELECT *, row_number() OVER (PARTITION BY version_hash ORDER BY (block % 3 = 0), source_page_url, row_pos) AS rn "
            "FROM listing) WHERE rn = 1"),
        "insert_bucketed": _with_listing(
            "SELECT version_hash AS _id, true AS _needs_download, source_page_url, row_pos, doc_name, download_url "
            "FROM (SELECT *, row_number() OVER (PARTITION BY version_hash ORDER BY (block % 3 = 0), source_page_url, row_pos) AS rn "
            "FROM listing) WHERE rn = 1"),
        "listing_errors": _with_listing(
            f"SELECT '{PAGE_ROOT}' || block::VARCHAR || '/' || suffix AS source_page_url, min(row_pos)::INTEGER AS row_pos, "
            "'E1_no_anchor' AS error FROM q WHERE bad GROUP BY block, suffix"),
        "header_position": _with_listing(
            f"SELECT DISTINCT '{PAGE_ROOT}' || block::VARCHAR || '/' || suffix AS source_page_url, 6::INTEGER AS header_pos FROM q"),
        "permissive": "WITH " + _LISTING_CTE.replace("(first_bad IS NULL OR row_pos < first_bad)", "NOT bad")
                      + "SELECT source_page_url, row_pos, doc_name FROM listing",
        "normalise_date": _with_listing(
            "SELECT source_page_url, row_pos, CASE WHEN empty_row THEN '' ELSE strftime(make_date(2020, (s % 12 + 1)::INTEGER, "
            "(k % 28 + 1)::INTEGER), '%Y-%m-%dT00:00:00') END AS publication_date FROM listing"),
        "office_by_header": _with_listing(
            "SELECT source_page_url, row_pos, CASE WHEN empty_row THEN '' ELSE b END AS office_primary_resp FROM listing"),
        "record_constants": _with_listing(
            "SELECT source_page_url, row_pos, 'dod_issuances' AS crawler_used, 'Dept. of Defense' AS display_org, "
            "'WHS DoD Directives Division' AS data_source, 'Unlisted Source' AS source_title, "
            "'WHS DoD Directives Division - Unlisted Source' AS display_source, false AS is_revoked, '' AS office_primary_resp, "
            "1::INTEGER AS n_items, CASE WHEN empty_row THEN NULL ELSE download_url END AS item_url, change_date FROM listing"),
        "require_fields": _with_listing("SELECT source_page_url, row_pos FROM listing WHERE NOT empty_row"),
        "project_hits": "SELECT doc_id, source FROM documents",
        "attach_metadata": _with_chunks(
            """SELECT doc_id, chunk_pos, '{"lang":"' || lang || '","source":"' || source || '"}' AS metadata
               FROM chunks JOIN documents USING (doc_id)"""),
        "vector_schema": "SELECT vec_id, len(embedding)::INTEGER AS dims FROM embeddings",
        "vector_profile": "SELECT len(embedding)::INTEGER AS dims, count(*) AS n_vectors FROM embeddings GROUP BY 1",
        "fingerprint": "SELECT doc_id, sha256(concat('(', chr(39), 'doc_id', chr(39), ', ', doc_id, ')(', chr(39), 'lang', chr(39), ', ', "
                       "chr(39), lang, chr(39), ')(', chr(39), 'long', chr(39), ', ', "
                       "CASE WHEN n_chars > 500 THEN 'True' ELSE 'False' END, ')')) AS fingerprint FROM documents",
        "snapshot_upsert": "WITH n AS (SELECT user_id AS id, max(event_id) AS value FROM events GROUP BY 1) "
                           "SELECT id, value FROM n UNION ALL SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT id FROM n)",
        "scan_store": _with_listing(
            "SELECT version_hash AS _id, doc_name, download_url FROM store ORDER BY version_hash LIMIT 10"),
        "download_worklist": _with_listing(
            "SELECT version_hash AS _id, CASE WHEN download_url = '' AND file_ext = 'Unkown' AND doc_name = '' "
            "THEN NULL ELSE 'pdf' END AS doc_type, CASE WHEN download_url = '' AND file_ext = 'Unkown' AND doc_name = '' "
            "THEN NULL ELSE download_url END AS download_url, NULL::VARCHAR AS compression_type FROM store"),
        "list_sources": _with_listing("SELECT DISTINCT 'dod_issuances' AS name FROM store"),
        "pending_count": _with_listing("SELECT count(*) AS count FROM store"),
        "anti_join_store": "SELECT doc_id, source FROM documents d WHERE NOT EXISTS "
                           "(SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
        "source_exists": "SELECT doc_id, source FROM documents d WHERE EXISTS "
                         "(SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
        "extract_links": "WITH " + _LINKS_CTE + "SELECT page_id, link_pos, href, link FROM links",
        "offsite_filter": "WITH " + _LINKS_CTE + ", h AS (SELECT *, lower(regexp_extract(link, "
                          "'^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host FROM links) "
                          "SELECT page_id, link_pos, href, link FROM h WHERE host = 'example.com' "
                          "OR host LIKE '%.example.com'",
        "offsite_join": "WITH " + _LINKS_CTE + ", h AS (SELECT *, lower(regexp_extract(link, "
                        "'^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host FROM links), "
                        "dom AS (SELECT DISTINCT lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS d "
                        "FROM pages JOIN labels ON doc_id = page_id WHERE toxic = 0) "
                        "SELECT page_id, link_pos, href, link FROM h WHERE EXISTS (SELECT 1 FROM dom WHERE d <> '' AND (host = d "
                        "OR ends_with(host, '.' || d)))",
        "canonical_links": "SELECT 'http://xn--bcher-kva.example/~user/%C3%A9/' || (p_partkey // 4) || '?a=' || (p_partkey // 4) % 7 || '&b=' "
                           "|| (p_partkey // 4) % 3 AS canonical, min(p_partkey) AS page_id FROM part GROUP BY p_partkey // 4",
        "date_forms": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
        "scan_page_files": "SELECT page_id, 'utf-8' AS charset, html FROM pages",
        "dedupe_links": "WITH " + _LINKS_CTE + ", c AS (SELECT *, lower(regexp_extract(link, "
                        "'^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)) || " + _escaped("regexp_extract(link, "
                        "'^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)', 1)") + " AS canonical FROM links) "
                        "SELECT canonical, page_id, link_pos, link FROM (SELECT *, row_number() OVER "
                        "(PARTITION BY canonical ORDER BY page_id, link_pos) AS rn FROM c) WHERE rn = 1",
        "chunk_text": _with_chunks("SELECT doc_id, chunk_pos, chunk FROM chunks"),
        "chunk_overlap": "WITH " + _OVERLAP_CTE + "SELECT doc_id, chunk_pos, chunk FROM chunks",
        "first_chunk": _with_chunks("SELECT doc_id, chunk_pos, chunk FROM chunks WHERE chunk_pos = 0"),
        "append_chunks": _with_chunks("SELECT doc_id, chunk_pos, sha256(doc_id::VARCHAR || '|' || chunk_pos::VARCHAR "
                                      "|| '|' || chunk) AS chunk_id FROM chunks"),
        "embed_chunks": _with_chunks(", " + _embed_cte(
            "(SELECT sha256(doc_id::VARCHAR || '|' || chunk_pos::VARCHAR || '|' || chunk) AS chunk_id, chunk FROM chunks)",
            "chunk_id", "chunk", "cv") + "SELECT key AS chunk_id, list_transform(vec, lambda x: round(x, 6)) AS embedding FROM cv"),
        "knn_topk": _knn_sql(q_embed, "qv"),
        "knn_topk_batch": _knn_sql(b_embed, "qv"),
        "knn_approx_recall": "SELECT (SELECT count(*) FROM benchmark) * least(2, (SELECT count(*) FROM embeddings)) AS n_exact, "
                             "true AS recall_reached, true AS tenth_compared",
        "ledger_state": """WITH o AS (SELECT CAST(user_id AS VARCHAR) AS _id, min(ts) AS start_time FROM events
            WHERE event_type = 'signup' GROUP BY 1),
          c AS (SELECT CAST(user_id AS VARCHAR) AS _id, ts FROM events WHERE event_type = 'purchase')
          SELECT o._id, CASE WHEN max(c.ts) IS NULL THEN 'IN PROGRESS' ELSE 'COMPLETE' END AS progress, o.start_time,
                 max(c.ts) AS completion, 'crawler' AS task, 'dod_issuances' AS name
          FROM o LEFT JOIN c ON o._id = c._id AND c.ts >= o.start_time GROUP BY o._id, o.start_time""",
        "corpus_profile": _with_chunks(""", pc AS (SELECT doc_id, count(*) AS n FROM chunks GROUP BY doc_id)
            SELECT source, count(*) AS n_docs, sum(n_chars) AS n_chars, coalesce(sum(n), 0) AS n_chunks
            FROM documents d LEFT JOIN pc USING (doc_id) GROUP BY source"""),
        "vector_entry": _with_chunks(", " + _embed_cte("(SELECT doc_id, chunk FROM chunks WHERE chunk_pos = 0)", "doc_id", "chunk", "fv")
            + "SELECT row_number() OVER (ORDER BY key) AS id, (row_number() OVER (ORDER BY key))::VARCHAR AS _id, "
            "'doc-' || key::VARCHAR AS name, 'a good description' AS description, "
            "list_transform(vec, lambda x: round(x, 6)) AS embedding FROM fv"),
        "upsert_by_id": "SELECT doc_id AS id, 'a good description' AS description FROM documents d WHERE NOT EXISTS "
                        "(SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) UNION ALL "
                        "SELECT doc_id AS id, 'quality=' || quality::VARCHAR AS description FROM labels",
        "robots_filter": "WITH " + _LINKS_CTE + ", pth AS (SELECT *, regexp_extract(link, "
                         "'^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)', 1) AS path FROM links) "
                         "SELECT page_id, link_pos, href, link FROM pth WHERE NOT (starts_with(path, '/the') "
                         "AND NOT starts_with(path, '/the,'))",
        "embed_stream": _with_chunks(", " + _embed_cte(
            "(SELECT sha256(doc_id::VARCHAR || '|' || chunk_pos::VARCHAR || '|' || chunk) AS chunk_id, chunk FROM chunks)",
            "chunk_id", "chunk", "cv") + "SELECT key AS chunk_id, list_transform(vec, lambda x: round(x, 6)) AS embedding FROM cv"),
        "run_stages": "SELECT doc_id, source, n_chars FROM documents d WHERE n_chars > 0 AND NOT EXISTS "
                      "(SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
        "export_utf8": _with_chunks("SELECT doc_id, chunk_pos, chunk FROM chunks"),
        "ingest_stream": _with_listing(
            "SELECT version_hash AS _id, true AS _needs_download, source_page_url, row_pos, doc_name, download_url "
            "FROM store"),
    }
