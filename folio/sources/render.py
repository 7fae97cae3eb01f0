"""Listing pages rendered by Spark from relational rows (render-then-parse).

The test tables carry no listing HTML, so listing operators are exercised on
pages that Spark renders from ``part``: one page per block of
``ROWS_PER_PAGE`` consecutive part keys, so page size is bounded whatever the
table size (no unbounded group is ever collected).  The rule below is the
whole contract; the DuckDB oracle computes the expected records straight from
``part`` with the same rule and never sees HTML.

Per part row k (p_partkey), s (p_size), t (p_type), b (p_brand):
  block = k div 20; page suffix = SUFFIXES[block % 7]
  row without class attribute when k % 11 = 3 (skipped)
  row with no cells when k % 29 = 7
  first cell without a link when k % 97 = 50 (ends the page)
  name text: dtm -> DTM-<ss>-<(s*13)%1000 as 3 digits>;
             140025 -> "<s>" for even k, "DoDI 1400.25" for odd k;
             other -> "<prefix> <s>.<s%7 as 2 digits> (<b>)", or "<prefix>-<s>" when k % 13 = 5
  title: t, wrapped in &quot; when k % 19 = 0, " FOUO" appended when k % 17 = 0
  change: "CH <s div 5>" and date "<s%12+1>/<s%28+1>/2019" when s % 5 = 0
  link: /Portals/54/Documents/<prefix lower>/<s> <t lower>.pdf (".PDF?ver=2" when k % 23 = 0)
Malformed form (``malformed=True``): a row with cells holds, when k % 5 = 2, an inner table of one row without class attribute
in its last cell; rows with k % 3 = 1 have no end tags of rows and cells, also in the inner table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_PAGE = 20
# Fixed render rule: page suffixes cycle over every page-type branch.
SUFFIXES = ["DoDD/", "dodi/", "dodm/", "inst/", "dtm/", "140025/", "dodd"]
PREFIXES = ["DoDD", "DoDI", "DoDM", "AI", "DTM", "DoDI", "DoDI"]
PAGE_ROOT = "https://www.esd.whs.mil/Directives/issuances/p"

HEADER = ("<tr><th>Issuance #</th><th>Date</th><th>Subject</th><th>CH #</th><th>CH Date</th>"
          "<th>Exp</th><th>OPR</th></tr>")
PAGE_HEAD = ('<!DOCTYPE html><html><head><title>Issuances</title><script>var t="<tr class=x>";</script>'
             '</head><body><!-- <table class="dnnGrid"><tr class="r"><td>trap</td></tr></table> -->'
             '<table class="other"><tr class="r"><td>wrong table</td></tr></table>'
             '<table class="x dnnGrid">')
PAGE_TAIL = "</table></body></html>"


def _pick(idx, values):
    out = F.lit(values[-1])
    for i in range(len(values) - 2, -1, -1):
        out = F.when(idx == i, F.lit(values[i])).otherwise(out)
    return out


def listing_row_html(part: DataFrame, malformed: bool = False) -> DataFrame:
    k, s = F.col("p_partkey"), F.col("p_size")
    block = F.floor(k / ROWS_PER_PAGE)
    ti = (block % len(SUFFIXES)).cast("int")
    suffix = _pick(ti, SUFFIXES)
    prefix = _pick(ti, PREFIXES)
    ss = F.lpad(s.cast("string"), 2, "0")
    name = (F.when(ti == 4, F.concat(F.lit("DTM-"), ss, F.lit("-"), F.lpad(((s * 13) % 1000).cast("string"), 3, "0")))
            .when(ti == 5, F.when(k % 2 == 0, s.cast("string")).otherwise(F.lit("DoDI 1400.25")))
            .when(k % 13 == 5, F.concat(prefix, F.lit("-"), s.cast("string")))
            .otherwise(F.concat(prefix, F.lit(" "), s.cast("string"), F.lit("."),
                                F.lpad((s % 7).cast("string"), 2, "0"), F.lit(" ("), F.col("p_brand"), F.lit(")"))))
    href = F.concat(F.lit("/Portals/54/Documents/"), F.lower(prefix), F.lit("/"), s.cast("string"), F.lit(" "),
                    F.lower(F.col("p_type")),
                    F.when(k % 23 == 0, F.lit(".PDF?ver=2")).otherwise(F.lit(".pdf")))
    title = F.col("p_type")
    title = F.when(k % 19 == 0, F.concat(F.lit("&quot;"), title, F.lit("&quot;"))).otherwise(title)
    title = F.when(k % 17 == 0, F.concat(title, F.lit(" FOUO"))).otherwise(title)
    has_chg = s % 5 == 0
    chg = F.when(has_chg, F.concat(F.lit("CH "), F.floor(s / 5).cast("string"))).otherwise(F.lit(""))
    chg_date = F.when(has_chg, F.concat((s % 12 + 1).cast("string"), F.lit("/"), (s % 28 + 1).cast("string"),
                                        F.lit("/2019"))).otherwise(F.lit(""))
    pub = F.concat((s % 12 + 1).cast("string"), F.lit("/"), (k % 28 + 1).cast("string"), F.lit("/2020"))
    cell0 = F.when(k % 97 == 50, F.concat(F.lit("<td>"), name, F.lit("</td>"))).otherwise(
        F.concat(F.lit('<td><a href="'), href, F.lit('">'), name, F.lit("</a></td>")))
    inner = F.when(k % 5 == 2, F.lit("<table><tr><td>note</td></tr></table>")).otherwise(F.lit(""))
    cells = F.concat(cell0, F.lit("<td>"), pub, F.lit("</td><td>"), title, F.lit("</td><td>"), chg,
                     F.lit("</td><td>\n  "), chg_date, F.lit("</td><td></td><td>"), F.col("p_brand"),
                     inner if malformed else F.lit(""), F.lit("</td>"))
    cells = F.when(k % 29 == 7, F.lit("")).otherwise(cells)
    open_tr = F.when(k % 11 == 3, F.lit("<tr>")).otherwise(F.lit('<tr class="r">'))
    row = F.concat(open_tr, cells, F.lit("</tr>\n"))
    if malformed:
        row = F.when(k % 3 == 1, F.regexp_replace(row, "</t[rd]>", "")).otherwise(row)
    url = F.concat(F.lit(PAGE_ROOT), block.cast("string"), F.lit("/"), suffix)
    return part.select(block.alias("block"), url.alias("url"), k.alias("k"), row.alias("row_html"))


def render_listing_pages(part: DataFrame, malformed: bool = False) -> DataFrame:
    """(page_id, url, html) with at most ROWS_PER_PAGE listing rows per page."""
    rows = listing_row_html(part, malformed)
    pages = rows.groupBy("block", "url").agg(
        F.array_sort(F.collect_list(F.struct("k", "row_html"))).alias("_r"))
    html = F.concat(F.lit(PAGE_HEAD + HEADER),
                    F.array_join(F.transform("_r", lambda x: x["row_html"]), ""), F.lit(PAGE_TAIL))
    return pages.select(F.col("block").alias("page_id"), "url", html.alias("html"))
