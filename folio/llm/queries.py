"""Registered queries of the corpus operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, collocations, decontam, exact_dedup, filter_audit, html_main, langid, near_dedup, token_files,
               topk, url_rules, warc)
from .common import table


def vocabulary() -> str:
    """Place of the tokenizer file that the contract names."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], rows.schema)
    return chat.digests(chat.render(rows.unionByName(own)))


def op2_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.assign(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.assign(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out, names = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), *names)


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_rules.judge(pages, url_rules.labelled_urls(pages, table(spark, sf_dir, "labels")))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.assign(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors.where(F.col("vec_id") % 100 == 0), vectors, k=10)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_html_main": op2_html_main,
    "op3_warc": op3_warc,
    "op4_bpe": op4_bpe,
    "op5_decontam": op5_decontam,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_token_files": op7_token_files,
    "op8_langid": op8_langid,
    "op9_url_rules": op9_url_rules,
    "op10_near_dedup": op10_near_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_topk": op12_topk,
    "op13_collocations": op13_collocations,
}

ORACLE_SQL = {
    "op1_chat_format": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
     e AS (SELECT *, length(text) + len(regexp_extract_all(text, '<\\*/?(s|role)>|\[\\*/?INST\]')) AS n,
                  length(role) + len(regexp_extract_all(role, '<\\*/?(s|role)>|\[\\*/?INST\]')) AS r FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(CASE role WHEN 'user' THEN n + 18 WHEN 'assistant' THEN n + 5 ELSE n + r + 17 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
    "op3_warc": """
WITH t AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
     p AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest FROM t),
     k AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS keep FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN keep = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keep = page_id THEN NULL ELSE keep END AS refers_to
FROM k""",
    "op5_decontam": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     bw AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS x
            FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM b WHERE len(w) > 0)),
     dw AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS x
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
     h AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.x = bw.x),
     hit AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM h) GROUP BY doc_id),
     it AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                   sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS s FROM h GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(s, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op6_exact_dedup": """
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
     g AS (SELECT x, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY x)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.x) AS text_sha256
FROM t JOIN g ON t.x = g.x""",
    "op10_near_dedup": r"""
WITH RECURSIVE
  d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
               ELSE list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' ')) END) AS x FROM d),
  n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
  p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
  l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.c + nb.c - i)),
  e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
  r AS (SELECT doc_id, doc_id AS reach FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reach = e.a)
SELECT r.doc_id, coalesce(any_value(n.c), 0) AS n_shingles, min(reach) AS component_id, r.doc_id = min(reach) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id""",
    "op11_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
     w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
     m AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
     f AS (SELECT w.doc_id, part, CASE WHEN len(w) < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
                  + CASE WHEN 100 * length(regexp_replace(w.t, '[^A-Z]+', '', 'g')) > 5 * length(w.t) THEN 4 ELSE 0 END
                  + CASE WHEN regexp_matches(w.t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN w.doc_id > m.least THEN 16 ELSE 0 END AS fails
           FROM w JOIN m ON w.t = m.t),
     l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
           FROM labels GROUP BY doc_id),
     g AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
           FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
     x AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(f, b)),
     o AS (SELECT x1.f || x2.f || x3.f || x4.f || x5.f AS filter_order, [x1.b, x2.b, x3.b, x4.b, x5.b] AS bits
           FROM x x1, x x2, x x3, x x4, x x5 WHERE (x1.b | x2.b | x3.b | x4.b | x5.b) = 31),
     s AS (SELECT filter_order, step, bits[step] AS bit, CAST(list_sum(bits[1:step]) AS INT) - bits[step] AS before
           FROM o, (SELECT unnest(range(1, 6)) AS step)),
     r AS (SELECT part, filter_order, step, bit,
                  sum(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
                  sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN n ELSE 0 END) AS removed,
                  sum(CASE WHEN fails & before <> 0 AND fails & bit <> 0 THEN n ELSE 0 END) AS redundant,
                  sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
                  sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN good ELSE 0 END) AS good_lost,
                  sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
           FROM s, g GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r""",
    "op12_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
     p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
           FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM r WHERE rank <= 10""",
    "op13_collocations": r"""
WITH d AS (SELECT doc_id, coalesce(lang, 'und') AS lang,
                  regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps
           FROM documents),
     w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(ps) AS p FROM d)),
     g AS (SELECT lang, m, array_to_string(w[k:k + m - 1], ' ') AS phrase
           FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM w, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m)),
     f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
     n AS (SELECT lang, count(*) AS n FROM g WHERE m = 1 GROUP BY lang),
     c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
     cut AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
             FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
     s AS (SELECT cut.lang, cut.phrase, a, k, p.f AS l, q.f AS r, n.n,
                  CAST((CAST(1000 AS HUGEINT) * a * n.n) // (CAST(p.f AS HUGEINT) * q.f) AS BIGINT) AS score
           FROM cut JOIN f p ON p.lang = cut.lang AND p.phrase = x JOIN f q ON q.lang = cut.lang AND q.phrase = y JOIN n ON n.lang = cut.lang),
     low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
     sub AS (SELECT lang, array_to_string(w[b:b + z - 1], ' ') AS phrase, max(a) AS longer
             FROM (SELECT lang, w, a, z, unnest(range(1, m - z + 2)) AS b FROM c, (SELECT unnest(range(2, 5)) AS z) WHERE z < m) GROUP BY 1, 2),
     k AS (SELECT low.* FROM low LEFT JOIN sub USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a),
     o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM k)
SELECT lang, rank, phrase, a, l, r, n, score FROM o WHERE rank <= 2000""",
}
