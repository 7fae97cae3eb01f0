"""Traps for the listing, link, ledger, store and chunk operators."""

import html as stdlib_html
import html.parser
import random

import pytest
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.functions.identity import fingerprint_text
from folio.operators import chunking as C
from folio.operators import ledger as G
from folio.operators import links as K
from folio.operators import listing as L
from folio.operators import store as S
from folio.operators import vectors as V
from folio.session import scratch_path

URL = "https://www.esd.whs.mil/Directives/issuances/dodd/"


def page(spark, rows, head="<tr><th>Issuance</th><th>OPR</th></tr>"):
    html = f'<table title="a class=other" class="x dnnGrid">{head}{rows}</table>'
    return spark.createDataFrame([(1, URL, html)], "page_id long, url string, html string")


def row(name, attrs='class="r"', anchor='href="/a.pdf"'):
    return f"<tr {attrs}><td><a {anchor}>{name}</a></td><td>OUSD</td></tr>"


def test_attributes_are_read_in_order(spark):
    pages = page(spark, row("no", 'title="no class here"') + row("DoDD 1.2", anchor='title="x href=/evil y" href="/1.pdf"')
                 + row("DoDD 3.4", "title='a > b' class", 'title="a > b" href=/2.pdf'))
    got = [(r.row_pos, r.doc_num, r.download_url) for r in L.extract_records(pages).orderBy("row_pos").collect()]
    assert got == [(2, "1.2", "https://www.esd.whs.mil/1.pdf"), (3, "3.4", "https://www.esd.whs.mil/2.pdf")]


def test_column_by_header_label(spark):
    pages = page(spark, row("DoDD 1.2"))
    assert [r.office_primary_resp for r in L.extract_records(pages, opr_header="OPR").collect()] == ["OUSD"]
    assert [r.office_primary_resp for r in L.extract_records(pages, opr_header="none").collect()] == [""]


class Reader(html.parser.HTMLParser):
    """Rows of cells' text, as the standard library's parser sees them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.cell = [], None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append((any(k == "class" for k, _ in attrs), []))
        elif tag == "td":
            self.rows[-1][1].append("")
            self.cell = True

    def handle_endtag(self, tag):
        self.cell = None if tag == "td" else self.cell

    def handle_data(self, data):
        if self.cell:
            self.rows[-1][1][-1] += data


def test_listings_agree_with_the_stdlib_parser(spark):
    rng = random.Random(4)
    rows = []
    for k in range(40):
        attrs = rng.choice(['class="r"', "class=r", "title='class'", 'title="> class=x" class=""', "CLASS", 'data-x="class"', ""])
        anchor = rng.choice(['href="/a b.pdf"', "title='>' href=/a.pdf", 'data-href="/no" HREF="/yes.pdf"'])
        cell = rng.choice(["DoDD 5.1", "DoDD&nbsp;5.2", "A &amp; B 7", "<b>DoDD</b> 5.3", "DoDD &lpar;x&rpar; 9", "x &#00000065; 1"])
        rows.append(f"<tr {attrs}><td><a {anchor}>{cell}</a></td><td>OUSD</td></tr>")
    html = "<tr><th>h</th></tr>" + "".join(rows)
    reader = Reader()
    reader.feed(html)
    want = {i: cells[0] for i, (has, cells) in enumerate(reader.rows) if i and has}
    got = {r.row_pos: r.doc_name for r in L.extract_records(page(spark, "".join(rows), "<tr><th>h</th></tr>")).collect()}
    frame = spark.createDataFrame(list(want.items()), "k int, cell string")
    clean = {r.k: r.x for r in frame.select("k", T.strip_parens(T.py_strip(T.collapse_ws("cell"))).alias("x")).collect()}
    assert got == clean


def test_character_references(spark):
    cases = {"&#00000065;": "A", "&#x0000000041;": "A", "&lpar;x&rpar;": "(x)", "&comma;&hyphen;&period;": ",‐.", "&NotEqualTilde;": "≂̸",
             "&#99999999;": "�", "&#xD800;": "�", "&#150;": "–", "&unknown;x": "&unknownx", "a & b": "a & b", "&amp": "&"}
    df = spark.createDataFrame(list(cases.items()), "raw string, want string")
    assert [r.raw for r in df.where(T.html_unescape("raw") != F.col("want")).collect()] == []
    named = [(f"&{n}", v) for n, v in stdlib_html.entities.html5.items() if n.endswith(";")]
    df = spark.createDataFrame(named, "raw string, want string")
    assert df.where(T.html_unescape("raw") != F.col("want")).count() == 0


def test_ledger_early_completion_keeps_the_task(spark):
    ev = spark.createDataFrame([("a", "open", 2, "n"), ("a", "complete", 1, None), ("b", "open", 2, "n"), ("b", "complete", 1, None),
                                ("b", "complete", 5, None), ("c", "complete", 5, None)], "_id string, event string, ts int, name string")
    assert sorted((r._id, r.progress, r.completion) for r in G.ledger_state(ev).collect()) == [
        ("a", "IN PROGRESS", None), ("b", "COMPLETE", 5)]
    sources = spark.createDataFrame([("n",)], "name string")
    assert G.ledger_open(spark.createDataFrame([("n", 1)], "name string, ts int"), sources).first()._id


def test_damaged_store_raises(spark, tmp_path):
    path = f"{tmp_path}/store"
    recs = spark.createDataFrame([("h1", "p", 0, "b")], "version_hash string, source_page_url string, row_pos int, doc_name string")
    assert S.read_store(spark, path) is None
    assert S.insert_if_absent(spark, recs, path) == 1
    for f in (tmp_path / "store").glob("*.parquet"):
        f.write_bytes(b"damaged")
    for f in (tmp_path / "store").glob(".*.crc"):
        f.unlink()
    with pytest.raises(Exception):
        S.insert_if_absent(spark, recs, path)


def test_upsert_of_repeated_ids(spark):
    old = spark.createDataFrame([(1, "old", 0), (2, "old", 0)], "id int, v string, at int")
    new = spark.createDataFrame([(1, "first", 1), (1, "last", 2), (3, "x", 1)], "id int, v string, at int")
    assert sorted((r.id, r.v) for r in S.upsert_by_id(old, new, order="at").collect()) == [(1, "last"), (2, "old"), (3, "x")]


def test_robots_groups_and_wildcards(spark):
    robots = "User-agent: badbot\nDisallow: /\n\nUser-agent: other\nUser-agent: *\nDisallow: /private # all\nDisallow: /*.pdf$\nAllow: /private/ok\n"
    table = spark.createDataFrame([("h.org", robots)], "host string, robots_txt string")
    links = spark.createDataFrame([(k,) for k in ("http://h.org/a", "http://h.org/private/x", "http://h.org/private/ok", "http://h.org/x.pdf",
                                                  "http://h.org/x.pdf?y", "http://none.org/private")], "link string")
    left = lambda agent: sorted(r.link for r in K.robots_filter(links, K.parse_robots(table, agent=agent)).collect())
    assert left("*") == ["http://h.org/a", "http://h.org/private/ok", "http://h.org/x.pdf?y", "http://none.org/private"]
    assert left("BadBot") == ["http://none.org/private"]


def test_links_of_a_class(spark):
    items = "".join(f'<a href="/{k}">{k}</a>' for k in range(7))
    html = f'<ul><li class="x"><a href="/no">n</a></li><li class="a col-sm-6 b">{items}</li></ul>'
    df = spark.createDataFrame([(1, "http://h/", html)], "page_id long, url string, html string")
    assert [r.link for r in K.extract_links(df, container="li.col-sm-6").orderBy("link_pos").collect()] == ["http://h/4", "http://h/5"]


def test_fingerprint_of_other_types(spark):
    df = spark.createDataFrame([(True, 5, None)], "b boolean, n bigint, s string")
    text = fingerprint_text({"b": "b", "n": "n", "s": "s"}, {"b": "boolean", "n": "bigint"})
    assert df.select(text.alias("t")).first().t == "('b', True)('n', 5)('s', None)"
    with pytest.raises(TypeError):
        fingerprint_text({"x": "x"}, {"x": "double"})


def test_recursive_chunks(spark):
    rng = random.Random(1)
    texts = ["", "a" * 250, "\n\n\n\n", "one two"] + ["".join(rng.choice(["ab", "c", " ", "\n", "\n\n", "long" * 9]) for _ in range(120)) for _ in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = C.chunk_recursive(df, chunk_size=40, chunk_overlap=10).collect()
    covered = {}
    for r in rows:
        t = texts[r.doc_id]
        assert t[r.start_index:r.start_index + len(r.chunk)] == r.chunk == r.chunk.strip() and 0 < len(r.chunk) <= 40
        covered.setdefault(r.doc_id, set()).update(range(r.start_index, r.start_index + len(r.chunk)))
    for k, t in enumerate(texts):
        assert {i for i, c in enumerate(t) if not c.isspace()} <= covered.get(k, set())


def test_knn_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(V, "QUERY_BLOCK", 7)
    monkeypatch.setattr(V, "VECTOR_BLOCK", 9)
    rng = random.Random(2)
    vec = lambda: [float(rng.randrange(3)) for _ in range(4)]
    vectors, queries = [(k, vec()) for k in range(60)], [(k, vec()) for k in range(30)]
    got = V.knn_topk_batch(spark, spark.createDataFrame(queries, "query_id int, vector array<double>"),
                           spark.createDataFrame(vectors, "id int, embedding array<double>"), k=5)
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.id))
    for k, q in queries:
        best = sorted(vectors, key=lambda v: (sum((a - b) ** 2 for a, b in zip(q, v[1])), v[0]))[:5]
        assert [i for _, i in sorted(found[k])] == [i for i, _ in best]
