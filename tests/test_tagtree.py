"""Nested tables and omitted end tags: the fold over tags against a tree built with the standard library's parser."""

import html.parser
import random
import time

import pytest
from pyspark.sql import functions as F

from folio.functions import tagtree
from folio.functions import text as T
from folio.operators import listing as L

URL = "https://www.esd.whs.mil/Directives/issuances/dodd/"


class Tree(html.parser.HTMLParser):
    """Elements with their text; ``implied`` closes cells and rows as HTML tables do."""

    def __init__(self, implied):
        super().__init__(convert_charrefs=True)
        self.implied, self.stack, self.all = implied, [], []

    def last(self, names, above=-1):
        return max([i for i, e in enumerate(self.stack) if e["name"] in names and i > above], default=None)

    def cut(self, place):
        if place is not None:
            self.stack = self.stack[:place]

    def handle_starttag(self, tag, attrs):
        if self.implied:
            table = self.last(["table"])
            table = -1 if table is None else table
            if tag in tagtree.CELLS:
                self.cut(self.last(tagtree.CELLS, table))
            elif tag in ("tr", *tagtree.SECTIONS):
                row = self.last(["tr"], table)
                self.cut(self.last(tagtree.CELLS, table) if row is None else row)
        e = {"name": tag, "attrs": attrs, "text": "", "parents": list(self.stack)}
        self.all.append(e)
        if tag not in tagtree.VOID:
            self.stack.append(e)

    def handle_startendtag(self, tag, attrs):
        before = tagtree.VOID
        self.handle_starttag(tag, attrs)
        if tag not in before:
            self.stack.pop()

    def handle_endtag(self, tag):
        above = -1
        if self.implied and tag in (*tagtree.WANTED, *tagtree.SECTIONS):
            table = self.last(["table"])
            above = -1 if table is None else table
        self.cut(self.last([tag], above))

    def handle_data(self, data):
        for e in self.stack:
            e["text"] += data

    def rows(self):
        """(has class, texts of the cells) of each row of the first table with the class."""
        table = next(e for e in self.all if e["name"] == "table" and "dnnGrid" in dict(e["attrs"]).get("class", "").split())
        out = []
        for r in (e for e in self.all if e["name"] == "tr" and any(p is table for p in e["parents"])):
            cells = [e["text"] for e in self.all if e["name"] == "td" and any(p is r for p in e["parents"])]
            out.append(("class" in dict(r["attrs"]), cells))
        return out


def random_table(rng):
    """Rows with inner tables, stray and missing end tags, void and self-closed elements."""
    out = ["<table class=dnnGrid>", rng.choice(["", "<thead>"]), "<tr><th>h<th>OPR</tr>", rng.choice(["", "</thead><tbody>"])]
    for k in range(rng.randrange(1, 7)):
        out.append(rng.choice(["<tr class=r>", "<tr>", "<TR CLASS>", '<tr title="</tr>" class="">']))
        for c in range(rng.randrange(0, 6)):
            out.append(rng.choice(["<td>", "<td>", "<TD align=left>", '<td title="a > b">']))
            out.append(rng.choice([f"c{k}.{c}", "<a href=/x>link</a>", "<b>bold", "x<br>y", "&amp;", "<img src=a/>", "<span>s</span></i>",
                                   "<table><tr class=in><td>deep</td></tr></table>", "<table><tr><td>open</table>tail", "<td/>", "</div>"]))
            out.append(rng.choice(["</td>", "</td>", ""]))
        out.append(rng.choice(["</tr>", "</tr>", "", "</tbody>"]))
    out += [rng.choice(["</table>", "</table><p>after<tr class=x><td>no", ""])]
    return "".join(out)


@pytest.mark.parametrize("tree", ["observed", "implied"])
def test_rows_equal_the_stdlib_tree(spark, tree):
    rng = random.Random(8)
    pages = [random_table(rng) for _ in range(250)]
    df = spark.createDataFrame(list(enumerate(pages)), "k int, html string").repartition(4)
    got = df.select("k", F.transform(tagtree.table_rows(F.col("html"), tree, 100), lambda r: F.struct(
        L._has_class(r).alias("c"), r["n"].alias("n"), F.transform(r["cells"], T.cell_text).alias("cells"))).alias("rows")).collect()
    for r in got:
        parser = Tree(tree == "implied")
        parser.feed(pages[r.k])
        parser.close()
        want = parser.rows()
        assert [(x.c, list(x.cells)) for x in r.rows] == want, pages[r.k]
        assert [x.n for x in r.rows] == [len(c) for _, c in want]


def records(spark, rows, **kw):
    html = f'<p><table class="x dnnGrid"><tr><th>Issuance</th><th>OPR</th></tr>{rows}</table>'
    pages = spark.createDataFrame([(1, URL, html)], "page_id long, url string, html string")
    assert L.listing_errors(pages, **kw).count() == 0
    return [(r.row_pos, r.doc_name, r.office_primary_resp) for r in L.extract_records(pages, opr_header="OPR", **kw).orderBy("row_pos").collect()]


def test_records_of_malformed_tables(spark):
    plain = "<tr class=r><td><a href=/a.pdf>DoDD 1.1</a></td><td>OUSD</td></tr>"
    nested = "<tr class=r><td><a href=/a>DoDD 2.2</a></td><td>P<table><tr><td>x</td></tr></table></td></tr>"
    unclosed = "<tr class=r><td><a href=/a>DoDD 3.3</a><td>USD"
    assert records(spark, plain + nested + plain) == [(1, "DoDD 1.1", "OUSD"), (2, "DoDD 2.2", "Px"), (4, "DoDD 1.1", "OUSD")]
    assert records(spark, unclosed + plain + unclosed) == [(1, "DoDD 3.3", "USD"), (2, "DoDD 1.1", "OUSD"), (3, "DoDD 3.3", "USD")]
    seen = records(spark, unclosed + plain, tree="observed")  # nothing closes the first cell
    assert [r[0] for r in seen] == [1, 2] and seen[0][1] == "DoDD 3.3USDDoDD 1.1OUSD OUSD" and seen[1][1:] == ("DoDD 1.1", "OUSD")


def test_table_without_its_end_tag(spark):
    html = '<table class="dnnGrid"><tr><th>h</th></tr><tr class=r><td><a href=/a>DoDD 1.1</a></td></tr>'
    pages = spark.createDataFrame([(1, URL, html)], "page_id long, url string, html string")
    assert [r.doc_name for r in L.extract_records(pages).collect()] == ["DoDD 1.1"]


def test_long_malformed_page_is_near_linear(spark):
    form = "<tr class=r><td><a href=/x>DoDD 1.{}</a><td>b<td>c<td>d<td>e<table><tr><td>i</table>\n"
    times = {}
    for n in (1000, 8000):
        html = '<table class="dnnGrid"><tr><th>h</tr>' + "".join(form.format(k) for k in range(n)) + "</table>"
        df = spark.createDataFrame([(html,)], "html string")
        t = time.time()
        assert df.select(F.size(tagtree.table_rows(F.col("html"), "implied", 6))).first()[0] == 2 * n + 1
        times[n] = time.time() - t
    assert times[8000] < 60, times
