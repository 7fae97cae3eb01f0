"""What keeps the work of a query in proportion to its input."""

import hashlib
import math
import pathlib

from folio.operators import listing as L
from folio.operators import vectors as V
from folio.sources.export import write_text_files

URL = "https://www.esd.whs.mil/Directives/issuances/dodd/"


def test_a_page_is_read_once(spark):
    """No filter below the explode: Spark would compute the rows of the page there a second time."""
    row = "<tr class=r><td><a href=/{0}.pdf>DoDD {0}.1</a><td>b<table><tr><td>i</table>"
    html = '<table class="dnnGrid"><tr><th>h</tr>' + "".join(row.format(k) for k in range(5)) + "<tr class=r><td>no link</tr></table>"
    pages = spark.createDataFrame([(1, URL, html), (2, URL, "<p>"), (3, URL, None)], "page_id long, url string, html string")
    records, errors = L.extract_records(pages), L.listing_errors(pages)
    for df in (records, errors):
        plan = df._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("Generate "):]
        assert "+- Filter " not in below and ") Filter " not in below
    assert [r.doc_name for r in records.orderBy("row_pos").collect()] == [f"DoDD {k}.1" for k in range(5)]
    assert [(r.row_pos, r.error) for r in errors.orderBy("error").collect()] == [(11, "E1_no_anchor"), (None, "P1_no_table")]


def test_embedding_shuffles_rows_not_tokens(spark):
    """Tokens are counted within a row: no explode before the exchange; rows that share their keys are still one vector."""
    rows = [(1, "The cat\nthe dog  é"), (1, "cat"), (2, None), (3, ""), (4, "THE " * 500)]
    out = V.hash_embed(spark.createDataFrame(rows, "k int, t string"), "t", ["k"], 8)
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.k: list(r.embedding) for r in out.collect()}
    for k in (1, 2, 3, 4):
        want = [0] * 8
        for t in " ".join(t for i, t in rows if i == k and t).replace("\n", " ").lower().split():
            h = hashlib.md5(t.encode()).hexdigest()
            want[int(h[:8], 16) % 8] += 1 if h[8] < "8" else -1
        norm = math.sqrt(sum(x * x for x in want)) or 1
        assert got[k] == [x / norm for x in want]


def test_text_files_of_keys(spark, tmp_path):
    """One flat folder a task, a file a key, rows of one key together, null as an empty line."""
    rows = [(k, f"é{k}" if k % 3 else None) for k in range(40)] + [(7, "again")]
    df = spark.createDataFrame(rows, "k long, v string").repartition(4, "k")
    folders = write_text_files(df, "k", "v", str(tmp_path / "out"))
    files = [p for f in folders for p in pathlib.Path(f).iterdir()]
    assert 1 < len(folders) <= 4 and len(files) == 40 and all(p.is_file() for p in files)
    text = {int(p.stem[5:]): p.read_text("utf-8") for p in files}
    assert sorted(text.pop(7).splitlines()) == ["again", "é7"]
    assert text == {k: f"é{k}\n" if k % 3 else "\n" for k in range(40) if k != 7}
    assert write_text_files(df.where("k < 0"), "k", "v", str(tmp_path / "none")) == []
