from folio.operators import listing as L

F1 = '''<!-- <table class="dnnGrid"><tr><td>trap</td></tr></table> -->
<table class="other"><tr class="r"><td>wrong table</td></tr></table>
<table class="x dnnGrid">
<tr><th>Issuance #</th><th>Date</th><th>Subject</th><th>CH #</th><th>CH Date</th><th>Exp</th><th>OPR</th></tr>
<tr class="r"><td><a href="/a.pdf">DoDD 5000.01 (series)</a></td><td>1/5/2020</td><td>The "Title"</td><td></td><td></td><td></td></tr>
<tr><td>no class attribute: skipped</td></tr>
<tr class=""><td><a href="/x/b c.PDF?ver=1">DoDD&nbsp;5000.02</a></td><td>January 5, 2020</td><td>A + B</td><td>CH 1</td><td>1/2/2020</td><td>9/9/2030</td></tr>
<tr class="r"></tr>
</table>
<table class="dnnGrid"><tr class="h"></tr><tr class="r"><td>second match: ignored</td></tr></table>'''
URL = 'https://www.esd.whs.mil/Directives/issuances/dodd/'


def _pages(spark, html, url=URL):
    return spark.createDataFrame([(1, url, html)], 'page_id long, url string, html string')


def test_fixture_f1(spark):
    rows = {r.row_pos: r for r in L.extract_records(_pages(spark, F1)).collect()}
    assert sorted(rows) == [1, 3, 4]
    r1, r3, r4 = rows[1], rows[3], rows[4]
    assert (r1.doc_name, r1.doc_num, r1.doc_title, r1.download_url, r1.file_ext, r1.display_title) == (
        'DoDD 5000.01', '5000.01', 'The Title', 'https://www.esd.whs.mil/a.pdf', 'pdf', 'DoDD 5000.01: The Title')
    assert r1.version_hash == '72cf25e9b368d653a347f3373da3a013171d5c18c6c4259eb233b9ef5c9fe7c3'
    assert (r3.doc_name, r3.doc_num, r3.doc_title, r3.download_url) == (
        'DoDD 5000.02 CH 1', '5000.02', 'A B', 'https://www.esd.whs.mil/x/b%20c.PDF?ver=1')
    assert (r4.doc_name, r4.download_url, r4.file_ext, r4.display_title) == ('', '', 'Unkown', 'DoDD : ')
    assert list(r4.downloadable_items) == [None]
    assert r1.doc_type == 'DoDD' and r1.display_doc_type == 'Directive' and r1.source_fqdn == 'www.esd.whs.mil'
    assert r1.publication_date == '' and r1.is_revoked is False and r1.crawler_used == 'dod_issuances'


def test_parsed_dates(spark):
    got = {r.row_pos: r.publication_date for r in L.extract_records(_pages(spark, F1), date_mode='parsed').collect()}
    assert got == {1: '2020-01-05T00:00:00', 3: '2020-01-05T00:00:00', 4: ''}


def test_abort_page_on_error(spark):
    html = F1.replace('<tr class=""><td><a href="/x/b c.PDF?ver=1">', '<tr class=""><td><a>')
    got = sorted(r.row_pos for r in L.extract_records(_pages(spark, html)).collect())
    assert got == [1]
    errs = L.listing_errors(_pages(spark, html)).collect()
    assert [(e.row_pos, e.error) for e in errs] == [(3, 'E2_no_href')]
    permissive = sorted(r.row_pos for r in L.extract_records(_pages(spark, html), mode='permissive').collect())
    assert permissive == [1, 4]


def test_page_failures(spark):
    assert L.extract_records(_pages(spark, '<p>no table</p>')).count() == 0
    errs = L.listing_errors(_pages(spark, '<p>no table</p>')).collect()
    assert errs[0].error == 'P1_no_table'


def test_name_number_branches(spark):
    cases = [('dtm/', 'DTM-08-003', 'DTM-08-003', '08-003'), ('dtm/', 'DTM 2020-001', 'DTM 2020-001', '20-001'),
             ('140025/', '2001', 'DoDI 1400.25 Volume 2001', '2001'), ('140025/', 'DoDI 1400.25', 'DoDI 1400.25', '1400.25'),
             ('inst/', 'AI-12', 'AI-12', '12'), ('inst/', 'Administrative Instruction 102', 'Administrative Instruction 102', 'Instruction'),
             ('dodd/', 'DoDD (x) 5000.01', 'DoDD  5000.01', '')]
    for suffix, cell, name, num in cases:
        html = ('<table class="dnnGrid"><tr><th>h</th></tr><tr class="r"><td><a href="/a.pdf">' + cell +
                '</a></td></tr></table>')
        r = L.extract_records(_pages(spark, html, 'https://www.esd.whs.mil/' + suffix)).first()
        assert (r.doc_name, r.doc_num) == (name, num), cell


def test_dtm_error(spark):
    html = '<table class="dnnGrid"><tr><th>h</th></tr><tr class="r"><td><a href="/a.pdf">DTM 8-03</a></td></tr></table>'
    assert L.extract_records(_pages(spark, html, 'https://www.esd.whs.mil/dtm/')).count() == 0
