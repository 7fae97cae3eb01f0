import os
import urllib.parse as up

from pyspark.sql import functions as F

from folio.functions import identity as I
from folio.functions import text as T
from folio.functions import urls as U

HREFS = ['/a/b c.pdf?ver=1', 'a.pdf', '../x/./y.pdf', '/a/../../b', '//h/p/../q', 'http://o/z', '?q=1', '#f', '',
         ' /lead', '/tab\there', 'mailto:a@b', 'a?', '/a/..;x', 'HTTPS://X/y', '..', 'g;x=1/../y', 'g?y/./x']
BASES = ['https://www.esd.whs.mil', 'http://a/b/c/d;p?q']


def test_join_url_matches_stdlib(spark):
    df = spark.createDataFrame([(b, h) for b in BASES for h in HREFS], 'b string, h string')
    for r in df.select('b', 'h', U.join_url(F.col('b'), F.col('h')).alias('j')).collect():
        assert r.j == up.urljoin(r.b, r.h), (r.b, r.h)


def test_bad_url_is_flagged(spark):
    r = spark.createDataFrame([('http://[bad',)], 'h string').select(U.url_error('h').alias('e')).first()
    assert r.e is True


def test_file_ext_and_netloc(spark):
    urls = ['https://h/a.tar.gz', 'https://h/a.PDF?x=y.z', 'https://h/a.pdf;v=1', 'https://h/.pdf', 'https://h/..pdf',
            'https://h/a.', 'https://h/d.x/a', '', 'https://u:p@Www.Esd.whs.mil:443/x;p=1?q#f']
    exp_ext = ['gz', 'pdf', 'pdf', 'Unkown', 'Unkown', 'Unkown', 'Unkown', 'Unkown', 'Unkown']
    rows = spark.createDataFrame([(u,) for u in urls], 'u string').select(
        'u', U.file_ext('u').alias('e'), U.netloc('u').alias('n')).collect()
    assert [r.e for r in rows] == exp_ext
    assert [r.n for r in rows] == [up.urlparse(u).netloc for u in urls]


def test_py_repr_matches_python(spark):
    strs = ["plain", "it's", 'say "hi"', "both ' and \"", "back\\slash", "tab\tnl\n", "nul\x00", "zw​sp",
            "emoji\U0001F600", "nbsp\xa0x", "\x7f\x80", "", " "]
    rows = spark.createDataFrame([(s,) for s in strs], 's string').select('s', T.py_repr('s').alias('r')).collect()
    for r in rows:
        assert r.r == repr(r.s)


def test_fingerprint_goldens(spark):
    cases = [
        ({"change_date": "", "display_title": "DoDD 5000.01: The Title", "doc_name": "DoDD 5000.01",
          "doc_num": "5000.01", "download_url": "https://www.esd.whs.mil/a.pdf", "pub_date": ""},
         "72cf25e9b368d653a347f3373da3a013171d5c18c6c4259eb233b9ef5c9fe7c3"),
        ({"change_date": "1/2/2020", "display_title": "DoDI 1000.01: Dep't Policy", "doc_name": "DoDI 1000.01 CH 1",
          "doc_num": "1000.01", "download_url": "https://www.esd.whs.mil/x/b%20c.pdf", "pub_date": ""},
         "01a290746df391a14dc6cacff0b41d407710fb2ca9d98c024e5da90a5c63dc2f"),
        ({"change_date": "", "display_title": "DTM 20-001: A\\B", "doc_name": "DTM 20-001", "doc_num": "20-001",
          "download_url": "https://www.esd.whs.mil/d.pdf", "pub_date": ""},
         "74991f0363df575c4da5cc1d6b184157f2d72a8349537b4799f52f616e4c0e24"),
        ({"change_date": "", "display_title": "DoDI CPM 2001: Zero​Width", "doc_name": "DoDI 1400.25 Volume 2001",
          "doc_num": "2001", "download_url": "https://www.esd.whs.mil/e.pdf", "pub_date": ""},
         "08aae51797895dfa5e17820811a15047ac4bcb9f2b468ac90baa484a72e35d99"),
    ]
    cols = sorted(cases[0][0])
    df = spark.createDataFrame([tuple(c[k] for k in cols) for c, _ in cases], ", ".join(f"{k} string" for k in cols))
    got = [r.h for r in df.select(I.fingerprint({k: k for k in cols}).alias("h")).collect()]
    assert got == [h for _, h in cases]


def test_clean_cell(spark):
    cells = ['  DoDD&nbsp;5000.02\n (x) ', 'A + B', '&amp;&lt;b&gt; &#65;&#x42; &foo; x', '<b>bold</b>text']
    rows = spark.createDataFrame([(c,) for c in cells], 'c string').select(T.clean_cell('c').alias('v')).collect()
    assert [r.v for r in rows] == ['DoDD 5000.02 (x)', 'A B', '&<b> AB &foo x', 'boldtext']
