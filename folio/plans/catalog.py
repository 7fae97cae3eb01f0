"""Registered queries (one per inventory item) and their DuckDB oracle SQL.

Every query reads the given tables (or data Spark derives from them) whole.
Listing operators run render-then-parse: Spark renders listing pages from
``part`` (folio.sources.render) and parses them back; the oracle computes the
expected records straight from ``part`` with the render rule, never from HTML.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.functions import urls as U
from folio.functions.dates import parse_date
from folio.functions.identity import fingerprint
from folio.operators import chunking as C
from folio.operators import ledger as G
from folio.operators import links as K
from folio.operators import listing as L
from folio.operators import store as S
from folio.operators import vectors as V
from folio.session import scratch_path
from folio.sources.export import write_text_files
from folio.sources.pages import scan_page_files
from folio.sources.render import render_listing_pages

CHUNK_SEP = "\n"          # documents hold no blank lines, so chunk on single newlines
CHUNK_SIZE = 1000
DIM = 64                  # dimension of the given embeddings table
QUESTION = "which report tells of the river and the bridge"
ALLOWED_DOMAINS = ["example.com"]
KNOWN_SOURCES = [L.CRAWLER_NAME]
LISTING_COLS = ["source_page_url", "row_pos", "doc_name", "doc_num", "doc_title", "doc_type", "display_doc_type",
                "publication_date", "cac_login_required", "download_url", "file_ext", "source_fqdn",
                "display_title", "version_hash"]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def listing_source(spark, d, malformed=False):
    """Listing pages rendered from ``part`` and materialised (reliable checkpoint in
    the shared folder), dealt out over the cores, so they behave like a scanned page table."""
    pages = render_listing_pages(_t(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size"), malformed)
    return pages.repartition(spark.sparkContext.defaultParallelism, "page_id").checkpoint(eager=True)


def records(spark, d, pages=None):
    return L.extract_records(pages if pages is not None else listing_source(spark, d))


def crawl_store(spark, d):
    """Store after a crawl of two thirds of the pages and then one of all: insert only unseen ids."""
    recs = records(spark, d).checkpoint(eager=True)
    block = F.regexp_extract("source_page_url", r"/p(\d+)/", 1).cast("bigint")
    path = scratch_path(spark, "store")
    S.insert_if_absent(spark, recs.where(block % 3 != 0), path)
    S.insert_if_absent(spark, recs, path)
    return S.read_store(spark, path)


def q_insert_bucketed(spark, d):
    """The same two crawls into a store bucketed by ``_id``."""
    recs = records(spark, d).checkpoint(eager=True)
    block = F.regexp_extract("source_page_url", r"/p(\d+)/", 1).cast("bigint")
    path = scratch_path(spark, "bucketed")
    table = path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in S.with_store_keys(recs).schema)
    S.open_bucketed(spark, table, path, schema, int(spark.conf.get("spark.sql.shuffle.partitions")))
    S.insert_bucketed(spark, recs.where(block % 3 != 0), table)
    S.insert_bucketed(spark, recs, table)
    return spark.table(table).select("_id", "_needs_download", "source_page_url", "row_pos", "doc_name", "download_url")


def chunks(spark, d):
    return C.chunk_text(_t(spark, d, "documents"), "text", "doc_id", CHUNK_SEP, CHUNK_SIZE, 0)


def _round_vec(c, nd=6):
    return F.transform(c, lambda x: F.round(x, nd))


# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------

def q_scan_pages(spark, d):
    return _t(spark, d, "pages").select("page_id", "url", "html")


def q_scan_documents(spark, d):
    return _t(spark, d, "documents").select("doc_id", "text", "lang", "source")


def q_extract_listing(spark, d):
    return records(spark, d).select(*LISTING_COLS)


def q_extract_malformed(spark, d):
    """Listing tables with inner tables and omitted end tags."""
    return records(spark, d, listing_source(spark, d, malformed=True)).select(*LISTING_COLS)


def q_listing_errors(spark, d):
    return L.listing_errors(listing_source(spark, d))


def q_header_position(spark, d):
    return L.header_position(listing_source(spark, d), "OPR")


def q_first_wins(spark, d):
    return S.first_wins(records(spark, d)).select("version_hash", "source_page_url", "row_pos", "doc_name")


def q_insert_if_absent(spark, d):
    return crawl_store(spark, d).select("_id", "_needs_download", "source_page_url", "row_pos", "doc_name",
                                        "download_url")


def q_scan_store(spark, d):
    return S.scan_store(crawl_store(spark, d)).select("_id", "doc_name", "download_url")


def q_download_worklist(spark, d):
    return S.download_worklist(crawl_store(spark, d))


def q_list_sources(spark, d):
    return S.list_sources(crawl_store(spark, d))


def q_pending_count(spark, d):
    return S.pending_count(crawl_store(spark, d))


def q_anti_join_store(spark, d):
    return S.new_records(_t(spark, d, "documents").select("doc_id", "source"), _t(spark, d, "labels"), key="doc_id")


def q_source_exists(spark, d):
    return S.source_exists(_t(spark, d, "documents").select("doc_id", "source"), _t(spark, d, "labels").select(
        "doc_id"), on="doc_id")


def q_extract_links(spark, d):
    return K.extract_links(_t(spark, d, "pages"))


def q_offsite_filter(spark, d):
    return K.offsite_filter(K.extract_links(_t(spark, d, "pages")), ALLOWED_DOMAINS)


def q_offsite_join(spark, d):
    """Links to hosts of pages whose document is labelled as not toxic, by a table of domains."""
    clean = _t(spark, d, "labels").where("toxic = 0").select(F.col("doc_id").alias("page_id"))
    domains = _t(spark, d, "pages").join(clean, "page_id", "left_semi").select(U.host(F.col("url")).alias("domain"))
    return K.offsite_filter_table(K.extract_links(_t(spark, d, "pages")), K.domain_table(domains))


def q_canonical_links(spark, d):
    """Four spellings of each URL, made from ``part``, meet in one canonical form."""
    k, n = F.col("p_partkey"), F.floor(F.col("p_partkey") / 4).cast("string")
    a, b = F.floor(F.col("p_partkey") / 4) % 7, F.floor(F.col("p_partkey") / 4) % 3
    spelled = (F.when(k % 4 == 0, F.concat(F.lit("HTTP://B\u00fccher.Example:80/%7euser/%c3%a9/"), n, F.lit("?b="), b, F.lit("&a="), a))
               .when(k % 4 == 1, F.concat(F.lit("http://xn--bcher-kva.example/~user/\u00e9/"), n, F.lit("?a="), a, F.lit("&b="), b, F.lit("#top")))
               .when(k % 4 == 2, F.concat(F.lit("http://b\u00fccher.example:/%7Euser/%C3%A9/"), n, F.lit("?%62="), b, F.lit("&%61="), a))
               .otherwise(F.concat(F.lit("Http://B\u00dcCHER.example/~user/%C3%a9/"), n, F.lit("?b="), b, F.lit("&&a="), a, F.lit("#"))))
    links = _t(spark, d, "part").select(k.alias("page_id"), F.lit(0).alias("link_pos"), spelled.alias("link"))
    return K.dedupe_links(links).select("canonical", "page_id")


def q_date_forms(spark, d):
    """Order dates written in ten forms and read back."""
    form = F.col("o_orderkey") % 10
    day = F.col("o_orderdate")
    forms = ["MMMM d, yyyy", "d MMM yyyy", "M/d/yyyy", "yyyy-MM-dd", "d.M.yyyy", "yyyyMMdd", "EEEE, MMMM dd, yyyy", "d-MMM-yy", "yyyy/M/d",
             "MMM d yyyy 'at' h:mm a"]
    text = F.date_format(day, forms[0])
    for i, f in enumerate(forms[1:], 1):
        text = F.when(form == i, F.date_format(day, f)).otherwise(text)
    return _t(spark, d, "orders").select("o_orderkey", F.date_format(parse_date(text), "yyyy-MM-dd").alias("day"))


def q_scan_page_files(spark, d):
    """Pages written as one file each, every second with a byte-order mark, and scanned as bytes."""
    path = scratch_path(spark, "page-files")
    marked = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("\ufeff"), "html")).otherwise(F.col("html"))
    folders = write_text_files(_t(spark, d, "pages").select("page_id", marked.alias("value")), "page_id", "value", path)
    return scan_page_files(spark, folders or path, "part-*").select(
        F.regexp_extract("path", r"/part-(\d+)\.txt$", 1).cast("bigint").alias("page_id"), "charset",
        F.regexp_replace("html", r"\n\z", "").alias("html"))


def q_dedupe_links(spark, d):
    return K.dedupe_links(K.extract_links(_t(spark, d, "pages")))


def q_chunk_text(spark, d):
    return chunks(spark, d)


def q_first_chunk(spark, d):
    return C.first_chunk(chunks(spark, d))


def q_append_chunks(spark, d):
    path = scratch_path(spark, "chunks")
    C.append_chunks(chunks(spark, d), path)
    return spark.read.parquet(path).select("doc_id", "chunk_pos", "chunk_id")


def q_embed_chunks(spark, d):
    v = V.hash_embed(C.chunk_ids(chunks(spark, d)), "chunk", ["chunk_id"], DIM)
    return v.select("chunk_id", _round_vec(F.col("embedding")).alias("embedding"))


def q_knn_topk(spark, d):
    q = spark.range(1).select(F.lit(0).cast("bigint").alias("query_id"), F.lit(QUESTION).alias("text"))
    qv = V.hash_embed(q, "text", ["query_id"], DIM, out="vector")
    out = V.knn_topk(spark, qv, _t(spark, d, "embeddings"), k=2, id_col="vec_id")
    return out.select("query_id", "rank", "id", F.round("score", 9).alias("score"))


def q_knn_topk_batch(spark, d):
    out = V.knn_topk_batch(spark, _benchmark_queries(spark, d), _t(spark, d, "embeddings"), k=2, id_col="vec_id")
    return out.select("query_id", "rank", "id", F.round("score", 9).alias("score"))


def _benchmark_queries(spark, d):
    items = _t(spark, d, "benchmark").withColumnRenamed("item_id", "query_id")
    return V.hash_embed(items, "text", ["query_id"], DIM, out="vector")


def q_knn_approx(spark, d):
    return V.knn_approx(_benchmark_queries(spark, d), _t(spark, d, "embeddings"), k=2, id_col="vec_id").select(
        "query_id", "rank", "id", F.round("score", 9).alias("score"))


def q_knn_index_cost(spark, d):
    """For each benchmark query the codes scanned, the vectors compared, and how many of its exact top-k the index found."""
    queries, vectors = _benchmark_queries(spark, d).checkpoint(eager=True), _t(spark, d, "embeddings")
    exact = V.knn_topk_batch(spark, queries, vectors, k=2, id_col="vec_id").select("query_id", "id")
    approx = V.knn_approx(queries, vectors, k=2, id_col="vec_id")
    hits = approx.join(exact, ["query_id", "id"], "left_semi").groupBy("query_id").agg(F.count(F.lit(1)).alias("found"))
    cost = approx.groupBy("query_id").agg(F.max("scanned").alias("scanned"), F.max("compared").alias("compared"))
    size = exact.groupBy("query_id").agg(F.count(F.lit(1)).alias("exact"))
    return size.join(cost, "query_id").join(hits, "query_id", "left").select(
        "query_id", "scanned", "compared", "exact", F.coalesce("found", F.lit(0)).alias("found"))


def q_knn_approx_recall(spark, d):
    """Whether the index finds 90 % of the exact results and compares at most a tenth of all pairs, over all queries."""
    n = _t(spark, d, "embeddings").count()
    return q_knn_index_cost(spark, d).agg(
        F.sum("exact").alias("n_exact"), (F.sum("found") >= 0.9 * F.sum("exact")).alias("recall_reached"),
        (F.sum("compared") <= F.lit(0.1 * n) * F.count(F.lit(1))).alias("tenth_compared"))


def q_ledger_state(spark, d):
    ev = _t(spark, d, "events")
    req = ev.where(F.col("event_type") == "signup").select(
        F.col("user_id").alias("_id"), "ts", F.lit(L.CRAWLER_NAME).alias("name"))
    sources = spark.createDataFrame([(n,) for n in KNOWN_SOURCES], "name string")
    opens = G.ledger_open(req, sources)
    comps = G.ledger_complete(ev.where(F.col("event_type") == "purchase").select(F.col("user_id").alias("_id"), "ts"))
    return G.ledger_state(opens.unionByName(comps))


def q_corpus_profile(spark, d):
    docs = _t(spark, d, "documents").select("source", "n_chars", F.size(C.chunk_array("text", CHUNK_SEP, CHUNK_SIZE)).alias("n"))
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").alias("n_chars"),
                                      F.sum(F.greatest("n", F.lit(0))).alias("n_chunks"))


def q_vector_profile(spark, d):
    """How many vectors there are of each width."""
    return _t(spark, d, "embeddings").groupBy(F.size("embedding").alias("dims")).agg(F.count(F.lit(1)).alias("n_vectors"))


def q_vector_entry(spark, d):
    vec = V.hash_embed(C.first_chunk(chunks(spark, d)), "chunk", ["doc_id"], DIM)
    docs = vec.select("doc_id", F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("name"), "embedding")
    out = V.vector_entries(spark, V.assert_dim(docs, "embedding", DIM), "doc_id", "embedding", "name")
    return out.select("id", "_id", "name", "description", _round_vec(F.col("embedding")).alias("embedding"))


def q_upsert_by_id(spark, d):
    docs = _t(spark, d, "documents")
    old = docs.select(F.col("doc_id").alias("id"), F.lit("a good description").alias("description"))
    new = _t(spark, d, "labels").select(F.col("doc_id").alias("id"), F.concat(
        F.lit("quality="), F.col("quality").cast("string")).alias("description"))
    return S.upsert_by_id(old, new, "id")


ROBOTS_TXT = "User-agent: *\nDisallow: /the\nAllow: /the,\n"


def q_embed_stream(spark, d):
    from folio.streaming.ingest import embed_documents_stream
    v = embed_documents_stream(spark, _t(spark, d, "documents"), CHUNK_SEP, CHUNK_SIZE, DIM)
    return v.select("chunk_id", _round_vec(F.col("embedding")).alias("embedding"))


def q_robots_filter(spark, d):
    links = K.extract_links(_t(spark, d, "pages"))
    hosts = links.select(U.host(F.col("link")).alias("host")).distinct()
    rules = K.parse_robots(hosts.withColumn("robots_txt", F.lit(ROBOTS_TXT)))
    return K.robots_filter(links, rules)


def q_run_stages(spark, d):
    from folio.operators.stages import run_stages
    docs = _t(spark, d, "documents").select("doc_id", "source", "n_chars")
    return run_stages(docs, [(800, lambda df: df.join(_t(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")),
                             (300, lambda df: df.where(F.col("n_chars") > 0))])


def q_export_utf8(spark, d):
    from folio.sources.export import export_utf8
    path = export_utf8(chunks(spark, d), scratch_path(spark, "export"))
    return spark.read.schema("doc_id bigint, chunk_pos int, chunk string").json(path)


def q_ingest_stream(spark, d):
    from folio.streaming.ingest import ingest_pages_stream
    return ingest_pages_stream(spark, render_listing_pages(_t(spark, d, "part"))).select(
        "_id", "_needs_download", "source_page_url", "row_pos", "doc_name", "download_url")


def q_permissive(spark, d):
    return L.extract_records(listing_source(spark, d), mode="permissive").select("source_page_url", "row_pos", "doc_name")


def q_normalise_date(spark, d):
    return L.extract_records(listing_source(spark, d), date_mode="parsed").select("source_page_url", "row_pos", "publication_date")


def q_office_by_header(spark, d):
    return L.extract_records(listing_source(spark, d), opr_header="OPR").select("source_page_url", "row_pos", "office_primary_resp")


def q_record_constants(spark, d):
    """The record columns that extract_listing leaves out."""
    raw = F.col("version_hash_raw_data")
    return records(spark, d).select(
        "source_page_url", "row_pos", "crawler_used", "display_org", "data_source", "source_title", "display_source", "is_revoked",
        "office_primary_resp", F.size("downloadable_items").alias("n_items"), F.col("downloadable_items")[0]["download_url"].alias("item_url"),
        raw["change_date"].alias("change_date"))


def q_require_fields(spark, d):
    return L.require_fields(records(spark, d), "strict", ["doc_name", "download_url"]).select("source_page_url", "row_pos")


def q_project_hits(spark, d):
    return S.project_hits(_t(spark, d, "documents"), ["doc_id", "source"])


def q_attach_metadata(spark, d):
    meta = _t(spark, d, "documents").select("doc_id", F.to_json(F.struct("lang", "source")).alias("metadata"))
    return C.attach_metadata(chunks(spark, d), by=meta, on="doc_id").select("doc_id", "chunk_pos", "metadata")


def q_vector_schema(spark, d):
    return V.assert_dim(_t(spark, d, "embeddings"), "embedding", DIM).select("vec_id", F.size("embedding").alias("dims"))


def q_fingerprint(spark, d):
    docs = _t(spark, d, "documents").withColumn("long", F.col("n_chars") > 500)
    return docs.select("doc_id", fingerprint({"doc_id": "doc_id", "lang": "lang", "long": "long"},
                                             {"doc_id": "bigint", "long": "boolean"}).alias("fingerprint"))


def q_chunk_overlap(spark, d):
    return C.chunk_text(_t(spark, d, "documents"), "text", "doc_id", CHUNK_SEP, CHUNK_SIZE, 200)


def q_chunk_recursive(spark, d):
    return C.chunk_recursive(_t(spark, d, "documents"))


def q_snapshot_upsert(spark, d):
    """Repeated ids in one upsert (the last by value stays), written as a snapshot and read back."""
    docs = _t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("n_chars").alias("value"))
    new = _t(spark, d, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("value"))
    path = S.write_snapshot(S.upsert_by_id(docs, new, "id", order="value"), scratch_path(spark, "snapshot"), 1)
    return spark.read.parquet(path)


QUERIES = {
    "permissive": q_permissive,
    "normalise_date": q_normalise_date,
    "office_by_header": q_office_by_header,
    "record_constants": q_record_constants,
    "require_fields": q_require_fields,
    "project_hits": q_project_hits,
    "attach_metadata": q_attach_metadata,
    "vector_schema": q_vector_schema,
    "vector_profile": q_vector_profile,
    "fingerprint": q_fingerprint,
    "chunk_overlap": q_chunk_overlap,
    "chunk_recursive": q_chunk_recursive,
    "snapshot_upsert": q_snapshot_upsert,
    "scan_pages": q_scan_pages,
    "scan_documents": q_scan_documents,
    "extract_listing": q_extract_listing,
    "extract_malformed": q_extract_malformed,
    "listing_errors": q_listing_errors,
    "header_position": q_header_position,
    "first_wins": q_first_wins,
    "insert_if_absent": q_insert_if_absent,
    "insert_bucketed": q_insert_bucketed,
    "scan_store": q_scan_store,
    "download_worklist": q_download_worklist,
    "list_sources": q_list_sources,
    "pending_count": q_pending_count,
    "anti_join_store": q_anti_join_store,
    "source_exists": q_source_exists,
    "extract_links": q_extract_links,
    "offsite_filter": q_offsite_filter,
    "offsite_join": q_offsite_join,
    "dedupe_links": q_dedupe_links,
    "canonical_links": q_canonical_links,
    "date_forms": q_date_forms,
    "scan_page_files": q_scan_page_files,
    "chunk_text": q_chunk_text,
    "first_chunk": q_first_chunk,
    "append_chunks": q_append_chunks,
    "embed_chunks": q_embed_chunks,
    "knn_topk": q_knn_topk,
    "knn_topk_batch": q_knn_topk_batch,
    "knn_approx": q_knn_approx,
    "knn_index_cost": q_knn_index_cost,
    "knn_approx_recall": q_knn_approx_recall,
    "ledger_state": q_ledger_state,
    "corpus_profile": q_corpus_profile,
    "vector_entry": q_vector_entry,
    "upsert_by_id": q_upsert_by_id,
    "ingest_stream": q_ingest_stream,
    "robots_filter": q_robots_filter,
    "embed_stream": q_embed_stream,
    "run_stages": q_run_stages,
    "export_utf8": q_export_utf8,
}
