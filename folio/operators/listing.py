"""Listing pages -> typed issuance records, as narrow DataFrame transforms.

Tables whose rows and cells all have their end tags are read by patterns; a page with nested tables or omitted end tags
is read by a fold over its tags with a stack of open elements (``folio.functions.tagtree``).

Every step is a Column expression over one page row or one listing row, so a
page never leaves its partition: no shuffle until records meet the store.
The "abort the rest of the page on the first bad row" rule is evaluated on the
page's row array before exploding, so it needs no window or exchange either.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions import tagtree
from folio.functions import text as T
from folio.functions import urls as U
from folio.functions.dates import parse_date
from folio.functions.identity import version_hash
from folio.functions.util import cached_columns, let

BASE_URL = "https://www.esd.whs.mil"

# Fixed values (must equal the reference for identical records and hashes).
# Page type by lower-cased URL suffix, tested in this order; otherwise "DoDI CPM".
PAGE_TYPES = [("dodd/", "DoDD"), ("dodi/", "DoDI"), ("dodm/", "DoDM"), ("inst/", "AI"), ("dtm/", "DTM")]
OTHER_PAGE_TYPE = "DoDI CPM"
# Display name of a lower-cased document type; otherwise "Document".
DISPLAY_TYPES = {"dod": "Issuance", "dodm": "Manual", "dodi": "Instruction", "dodd": "Directive",
                 "ai": "Instruction", "dtm": "Memorandum"}
DEFAULT_DISPLAY_TYPE = "Document"
# Substrings marking a restricted (login-required) document.
RESTRICTED_MARKERS = ["CAC", "PKI certificate required", "placeholder", "FOUO"]
# Record constants.
CRAWLER_NAME = "dod_issuances"
DISPLAY_ORG = "Dept. of Defense"
DATA_SOURCE = "WHS DoD Directives Division"
SOURCE_TITLE = "Unlisted Source"

# A tag's rest reaches its ">" over quoted values, and attributes are read in order, so that text
# within the value of one attribute is never taken for another.
REST = T.TAG_REST
TR_RE = rf"(?is)<tr(?=[\s/>]){REST}>.*?</tr\s*>"
TR_ATTRS_RE = rf"(?is)^<tr(?=[\s/>])({REST})>"
TD_RE = rf"(?is)<td(?=[\s/>]){REST}>(.*?)</td\s*>"
TH_RE = rf"(?is)<th(?=[\s/>]){REST}>(.*?)</th\s*>"
A_ATTRS_RE = rf"(?is)<a(?=[\s/>])({REST})>"
_SEP = r"""(?:[\s/]+|(?<=["']))"""
_ATTRS_BEFORE = rf"""(?:{_SEP}[^\s=>"'/]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+))?)*?{_SEP}"""
HREF_RE = rf"""(?is)^{_ATTRS_BEFORE}href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
CLASS_ATTR_RE = rf"(?is)^{_ATTRS_BEFORE}class(?=[\s=/]|$)"
TABLE_TAGS_RE = r"(?i)<(/?t(?:able|body|foot|head|r|d|h))(?=[\s/>])"
RECORD_CELLS = 6  # cells of a row that are read


def start_tag_regex(tag: str, css_class: str | None = None) -> str:
    """Start tag of a ``tag`` element, with a class list that contains ``css_class`` (case-sensitive token) if one is given."""
    c = re.escape(css_class or "")
    wanted = "" if css_class is None else (
        rf"""{_ATTRS_BEFORE}(?i:class)\s*=\s*(?:"(?:[^"]*\s)?{c}(?:\s[^"]*)?"|'(?:[^']*\s)?{c}(?:\s[^']*)?'|{c}(?=[\s/>]))""")
    return rf"(?s)<(?i:{tag})(?=[\s/>]){wanted}{REST}>"


def element_regex(tag: str, css_class: str | None = None) -> str:
    """First such element (group 1: what it holds, up to the first end tag of its name)."""
    return rf"{start_tag_regex(tag, css_class)}(.*?)</(?i:{tag})\s*>"


def table_regex(table_class: str) -> str:
    return element_regex("table", table_class)


def _regular(table: Column) -> Column:
    """Whether a table is a plain sequence of rows of cells, each with its end tag, so that patterns read it right."""
    order = F.concat(F.array_join(F.transform(F.regexp_extract_all(table, F.lit(TABLE_TAGS_RE), 1), F.lower), ","), F.lit(","))
    for pair in ("td,/td,", "th,/th,", "tr,/tr,"):
        order = F.replace(order, F.lit(pair), F.lit(""))
    for section in tagtree.SECTIONS:
        order = F.replace(order, F.lit(f"{section},/{section},"), F.lit(""))
    return order.isin("", ",")


def _regular_rows(table: Column) -> Column:
    """array<struct<tag, n, cells, heads>> of a regular table's rows."""
    def row(r: Column, i: Column) -> Column:
        return let(F.regexp_extract_all(r, F.lit(TD_RE), 1), lambda cells: F.struct(
            F.regexp_extract(r, TR_ATTRS_RE, 0).alias("tag"), F.size(cells).alias("n"), cells.alias("cells"),
            F.when(i == 0, F.regexp_extract_all(r, F.lit(TH_RE), 1)).otherwise(F.array().cast("array<string>")).alias("heads")))
    return F.transform(F.regexp_extract_all(table, F.lit(TR_RE), 0), row)


def classify_page(url) -> Column:
    """Document type of a listing page from its URL suffix."""
    u = F.lower(url if isinstance(url, Column) else F.col(url))
    out = F.lit(OTHER_PAGE_TYPE)
    for suffix, t in reversed(PAGE_TYPES):
        out = F.when(F.endswith(u, F.lit(suffix)), F.lit(t)).otherwise(out)
    return out


def page_kind(url) -> Column:
    """Number-parsing branch: 'dtm', '140025' or 'default'."""
    u = F.lower(url if isinstance(url, Column) else F.col(url))
    return (F.when(F.endswith(u, F.lit("dtm/")), F.lit("dtm"))
            .when(F.endswith(u, F.lit("140025/")), F.lit("140025"))
            .otherwise(F.lit("default")))


def display_type(doc_type) -> Column:
    items = []
    for k, v in DISPLAY_TYPES.items():
        items += [F.lit(k), F.lit(v)]
    t = doc_type if isinstance(doc_type, Column) else F.col(doc_type)
    return F.coalesce(F.try_element_at(F.create_map(*items), F.lower(t)), F.lit(DEFAULT_DISPLAY_TYPE))


def restricted_flag(url: Column, title: Column) -> Column:
    cond = F.lit(False)
    for m in RESTRICTED_MARKERS:
        cond = cond | url.contains(m) | title.contains(m)
    return cond


def href_of(anchor_attrs: Column) -> Column:
    """Value of the href attribute (entity references decoded); NULL if absent."""
    def value(a: Column) -> Column:
        v = F.concat(*[F.regexp_extract(a, HREF_RE, k) for k in (1, 2, 3)])
        return F.when(a.rlike(HREF_RE), T.html_unescape(v))
    return let(anchor_attrs, value)


def _dtm_num(name: Column) -> Column:
    return F.regexp_extract(name, r"(?U)\d{2}.\d{3}", 0)


def _tokens(name: Column) -> Column:
    return F.filter(F.split(name, " ", -1), lambda t: t != "")


def parse_number(kind: Column, name: Column) -> Column:
    """struct<doc_name, doc_num> from the cleaned, paren-stripped first cell."""
    toks = _tokens(name)
    t0 = F.try_element_at(toks, F.lit(1))
    cpm_name = F.when(t0 != "DoDI", F.concat(F.lit("DoDI 1400.25 Volume "), t0)).otherwise(
        T.py_strip(F.array_join(toks, " ")))
    cpm_num = F.when(t0 != "DoDI", t0).otherwise(F.try_element_at(toks, F.lit(-1)))
    dflt_num = F.when(F.instr(name, " ") > 0, F.split(name, " ", -1)[1]).otherwise(
        F.try_element_at(F.split(name, "-", -1), F.lit(-1)))
    doc_name = F.when(kind == "140025", cpm_name).otherwise(name)
    doc_num = (F.when(kind == "dtm", _dtm_num(name))
               .when(kind == "140025", cpm_num)
               .otherwise(dflt_num))
    return F.struct(doc_name.alias("doc_name"), doc_num.alias("doc_num"))


def _has_class(row: Column) -> Column:
    return F.regexp_extract(row["tag"], TR_ATTRS_RE, 1).rlike(CLASS_ATTR_RE)


def _row_error(kind: Column, row: Column) -> Column:
    """Error code of one listing row (NULL when it parses): the reference ends the page there."""
    def of_link(href: Column) -> Column:
        return F.when(href.isNull(), F.lit("E2_no_href")).when(U.url_error(href), F.lit("E5_bad_url"))

    def of_name(name: Column) -> Column:
        return (F.when((kind == "dtm") & (_dtm_num(name) == ""), F.lit("E3_no_dtm_number"))
                .when((kind == "140025") & (F.size(_tokens(name)) == 0), F.lit("E4_empty_name")))

    def of_cell(cell: Column) -> Column:
        return F.when(~cell.rlike(A_ATTRS_RE), F.lit("E1_no_anchor")).otherwise(F.coalesce(
            let(href_of(F.regexp_extract(cell, A_ATTRS_RE, 1)), of_link),
            F.when(kind.isin("dtm", "140025"), let(T.strip_parens(T.clean_cell(cell)), of_name))))

    return (F.when(~_has_class(row) | (row["n"] == 0), F.lit(None).cast("string"))
            .otherwise(let(F.try_element_at(row["cells"], F.lit(1)), of_cell)))


@cached_columns
def _page_cols(table_class: str, opr_header: str | None = None, tree: str = "implied"):
    tre, start = table_regex(table_class), start_tag_regex("table", table_class)
    s1 = ["source_page_url", "_html", page_kind(F.col("source_page_url")).alias("_kind"),
          F.col("_html").rlike(start).alias("_found"), F.col("_html").rlike(tre).alias("_closed"),
          F.regexp_extract(F.col("_html"), tre, 1).alias("_table")]
    cells = RECORD_CELLS if opr_header is None else 1 << 20  # a column named by its header may stand anywhere
    folded = tagtree.table_rows(F.regexp_extract(F.col("_html"), f"{start}.*", 0), tree, cells)
    s2 = ["source_page_url", "_kind", "_found", "_html", "_table", (F.col("_closed") & _regular(F.col("_table"))).alias("_plain")]
    s3 = ["source_page_url", "_kind", "_found",
          F.when(F.col("_found"), F.when(F.col("_plain"), _regular_rows(F.col("_table"))).otherwise(folded)).alias("_rows")]  # a null page has none
    header = _header_index(F.try_element_at("_rows", F.lit(1))["heads"], opr_header) if opr_header else F.lit(None)
    errs = F.transform("_rows", lambda r, i: F.when(i == 0, F.lit(None).cast("string"))
                       .otherwise(_row_error(F.col("_kind"), r))).alias("_errs")
    first_bad = F.array_position(F.transform("_errs", lambda e: e.isNotNull()), True)
    s4 = ["source_page_url", "_kind", "_rows", "_errs", header.cast("int").alias("_opr_pos"),
          F.when(~F.col("_found"), F.lit("P1_no_table"))
          .when(F.size("_rows") == 0, F.lit("P2_no_rows")).alias("page_error"),
          F.when(first_bad > 0, first_bad - 1).otherwise(F.size("_rows")).alias("_first_bad")]
    return s1, s2, s3, errs, s4


def listing_pages(pages: DataFrame, url_col: str = "url", html_col: str = "html", table_class: str = "dnnGrid",
                  opr_header: str | None = None, tree: str = "implied") -> DataFrame:
    """Page-level stage: the rows of the listing table, page status and first failing row.

    ``tree``: how elements without their end tag close, see ``folio.functions.tagtree``; regular tables do not depend on it."""
    s1, s2, s3, errs, s4 = _page_cols(table_class, opr_header, tree)
    p = pages.select(
        F.col(url_col).alias("source_page_url"),
        T.strip_raw_blocks(F.col(html_col)).alias("_html"))
    return p.select(*s1).select(*s2).select(*s3).select("*", errs).select(*s4)


def listing_errors(pages: DataFrame, **kw) -> DataFrame:
    """Error table: failed pages (row_pos NULL) and the row that ended each page."""
    p = listing_pages(pages, **kw)
    first = F.struct(F.col("_first_bad").cast("int").alias("row_pos"),
                     F.try_element_at("_errs", (F.col("_first_bad") + 1).cast("int")).alias("error"))
    page = F.struct(F.lit(None).cast("int").alias("row_pos"), F.col("page_error").alias("error"))
    # filtered after the explode: a filter before it is pushed below the page's columns and reads the page once more
    found = F.when(F.col("page_error").isNotNull(), F.array(page)).when(F.col("_first_bad") < F.size("_rows"), F.array(first))
    return p.select("source_page_url", F.explode_outer(found).alias("e")).where("e.error IS NOT NULL").select(
        "source_page_url", "e.row_pos", "e.error")


def listing_rows(pages: DataFrame, mode: str = "abort", **kw) -> DataFrame:
    """One row per class-bearing listing row that the reference turns into a record.

    mode ``abort``: rows from the first failing row on are dropped (reference);
    ``permissive``: only failing rows are dropped (they are in ``listing_errors``).
    """
    # a page with an error has no rows.  The filter stands after an outer explode, and says nothing that Spark could infer for a
    # page's own columns: a filter on those, or on an inner explode, is pushed below them and reads the page once more
    p = listing_pages(pages, **kw)
    p = p.select("source_page_url", "_kind", "_first_bad", "_opr_pos",
                 F.posexplode_outer(F.arrays_zip(F.col("_rows").alias("row"), F.col("_errs").alias("err"))))
    keep = (F.col("pos") > 0) & _has_class(F.col("col.row"))
    keep = keep & ((F.col("pos") < F.coalesce("_first_bad", F.lit(0))) if mode == "abort" else F.col("col.err").isNull())
    return p.where(keep).select("source_page_url", F.col("pos").cast("int").alias("row_pos"), "_kind", "_opr_pos",
                                F.col("col.row.cells").alias("_cells"), F.col("col.row.n").alias("_n"))


@cached_columns
def _record_cols(date_mode: str, base_url: str, opr_header):
    def cell(i):
        return T.clean_cell(F.coalesce(F.try_element_at(F.col("_cells"), F.lit(i + 1)), F.lit("")))

    s2 = ["source_page_url", "row_pos", "_kind",
          "_n", href_of(F.regexp_extract(F.coalesce(F.try_element_at("_cells", F.lit(1)), F.lit("")), A_ATTRS_RE, 1))
          .alias("_href"),
          T.strip_parens(cell(0)).alias("_name0"),
          cell(1).alias("_pub"), cell(2).alias("_title"), cell(3).alias("_chg"), cell(4).alias("_chg_date"),
          (F.try_element_at("_cells", F.col("_opr_pos") + 1) if opr_header else F.lit(None)).alias("_opr_raw")]
    s3 = ["*",
          F.when(F.col("_n") > 0, U.resolve_download_url(F.col("_href"), base_url)).otherwise(F.lit(""))
          .alias("_url"),
          parse_number(F.col("_kind"), F.col("_name0")).alias("_num")]
    has = F.col("_n") > 0
    doc_name0 = F.when(has, F.col("_num.doc_name")).otherwise(F.lit(""))
    doc_name0 = F.when((F.col("_n") > 3) & (F.col("_chg") != ""),
                       F.concat(doc_name0, F.lit(" "), F.col("_chg"))).otherwise(doc_name0)
    s4 = ["source_page_url", "row_pos", "_url", "_pub", "_chg_date", "_n", "_opr_raw",
          T.py_strip(doc_name0).alias("doc_name"),
          F.replace(F.col("_title"), F.lit('"'), F.lit("")).alias("doc_title"),
          T.py_strip(F.when(has, F.col("_num.doc_num")).otherwise(F.lit(""))).alias("doc_num"),
          classify_page(F.col("source_page_url")).alias("doc_type"),
          (has & restricted_flag(F.col("_url"), F.col("_title"))).alias("cac_login_required")]
    if date_mode == "parsed":
        pub = T.py_strip(F.col("_pub"))
        ts = parse_date(pub)
        pub_date = F.when(ts.isNotNull(), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(pub)
    else:
        pub_date = F.lit("")
    display_title = F.concat(F.col("doc_type"), F.lit(" "), F.col("doc_num"), F.lit(": "), F.col("doc_title"))
    s5 = ["*", pub_date.alias("publication_date"), display_title.alias("display_title"),
          T.py_strip(F.col("_chg_date")).alias("_change_date")]
    raw = F.struct(F.col("_url").alias("download_url"), F.col("publication_date").alias("pub_date"),
                   F.col("_change_date").alias("change_date"), F.col("doc_num"), F.col("doc_name"),
                   F.col("display_title"))
    item = F.when(F.col("_n") > 0, F.struct(F.lit("pdf").alias("doc_type"), F.col("_url").alias("download_url"),
                                            F.lit(None).cast("string").alias("compression_type")))
    s6 = ["*", raw.alias("version_hash_raw_data")]
    opr = T.clean_cell(F.coalesce(F.col("_opr_raw"), F.lit(""))) if opr_header else F.lit("")
    s7 = ["doc_name", "doc_title", "doc_num", "doc_type",
          display_type(F.col("doc_type")).alias("display_doc_type"),
          "publication_date", "cac_login_required",
          F.lit(CRAWLER_NAME).alias("crawler_used"),
          F.array(item).alias("downloadable_items"),
          "source_page_url",
          U.netloc(F.col("source_page_url")).alias("source_fqdn"),
          F.col("_url").alias("download_url"),
          "version_hash_raw_data",
          version_hash(F.col("version_hash_raw_data")).alias("version_hash"),
          F.lit(DISPLAY_ORG).alias("display_org"),
          F.lit(DATA_SOURCE).alias("data_source"),
          F.lit(SOURCE_TITLE).alias("source_title"),
          F.lit(f"{DATA_SOURCE} - {SOURCE_TITLE}").alias("display_source"),
          "display_title",
          U.file_ext(F.col("_url")).alias("file_ext"),
          F.lit(False).alias("is_revoked"),
          opr.alias("office_primary_resp"),
          "row_pos"]
    return [s2, s3, s4, s5, s6, s7]


def extract_records(pages: DataFrame, mode: str = "abort", date_mode: str = "observed",
                    base_url: str = BASE_URL, opr_header: str | None = None, **kw) -> DataFrame:
    """Listing pages -> issuance records (22 reference fields + ``row_pos``).

    ``date_mode='observed'`` reproduces the reference (publication_date is
    always empty, D-1); ``'parsed'`` normalises dates to yyyy-MM-ddTHH:mm:ss and keeps texts that are none.
    Each stage is one narrow ``select``; no stage shuffles.
    """
    r = listing_rows(pages, mode=mode, opr_header=opr_header, **kw)
    for cols in _record_cols(date_mode, base_url, opr_header):
        r = r.select(*cols)
    return r


def header_position(pages: DataFrame, label: str, url_col: str = "url", html_col: str = "html",
                    table_class: str = "dnnGrid") -> DataFrame:
    """0-based index of the last header cell of the listing table whose text is ``label``."""
    p = listing_pages(pages, url_col, html_col, table_class)
    return p.select("source_page_url", _header_index(F.try_element_at("_rows", F.lit(1))["heads"], label).alias("header_pos"))


def _header_index(heads: Column, label: str) -> Column:
    """0-based index of the last of the header cells whose text is ``label``; NULL if there is none."""
    hits = F.filter(F.transform(heads, lambda h, i: F.when(T.py_strip(T.cell_text(h)) == label, i)), lambda x: x.isNotNull())
    return F.try_element_at(hits, F.lit(-1))


def require_fields(records: DataFrame, mode: str = "observed", cols: list[str] | None = None) -> DataFrame:
    """Record validation: ``observed`` keeps everything (the reference's check never drops);
    ``strict`` drops records whose named columns are NULL or empty strings."""
    if mode == "observed" or not cols:
        return records
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    return records.where(cond)
