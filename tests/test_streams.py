"""Streams with keyed state: batches, event order, replay, fresh checkpoints; embedders and how often they are asked."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from folio.operators import embedding as E
from folio.operators import listing as L
from folio.operators import store as S
from folio.operators import vectors as V
from folio.session import scratch_path
from folio.sources.render import render_listing_pages
from folio.streaming import ingest

@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Few state stores: each is a task and a Python worker a batch."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


URL = "https://www.esd.whs.mil/Directives/issuances/{}/dodd/"


def key(df):
    return sorted((r._id, r.source_page_url, r.row_pos) for r in df.select("_id", "source_page_url", "row_pos").collect())


def pages(spark, *rows):
    html = '<table class="dnnGrid"><tr><th>h</th></tr>{}</table>'
    cell = "<tr class=r><td><a href=/a.pdf>DoDD {}</a></td></tr>"
    return spark.createDataFrame([(n, URL.format(u), html.format("".join(cell.format(x) for x in names)))
                                  for n, (u, names) in enumerate(rows)], ingest.PAGE_SCHEMA)


def test_batches_give_the_first_writers(spark):
    part = spark.createDataFrame([(k, f"B{k % 3}", f"TYPE {k % 5}", k % 4 + 1) for k in range(120)],
                                 "p_partkey long, p_brand string, p_type string, p_size int")
    listing = render_listing_pages(part)
    store = ingest.ingest_pages_stream(spark, listing)
    assert store.select("batch_id").distinct().count() > 1
    assert key(store) == key(S.first_wins(S.with_store_keys(L.extract_records(listing)), key="_id"))


def test_earlier_batch_wins_replay_and_fresh_checkpoint(spark):
    root = scratch_path(spark, "stream-test").removeprefix("file:")
    folder, store, ckpt = f"{root}/pages", f"{root}/store", f"{root}/one"

    def run(checkpoint):
        ingest.start_ingest(spark, folder, store, checkpoint, files_per_batch=1).awaitTermination()
        return key(spark.read.parquet(store))

    pages(spark, ("z", ["1.1", "2.2", "1.1"])).coalesce(1).write.mode("append").parquet(folder)
    first = run(ckpt)
    assert sorted((u, p) for _, u, p in first) == [(URL.format("z"), 1), (URL.format("z"), 2)]
    pages(spark, ("a", ["2.2", "3.3"])).coalesce(1).write.mode("append").parquet(folder)  # a smaller URL, but later
    second = run(ckpt)
    assert sorted((u, p) for _, u, p in second) == [(URL.format("a"), 2), (URL.format("z"), 1), (URL.format("z"), 2)]

    last = max(int(os.path.basename(p)) for p in glob.glob(f"{ckpt}/commits/[0-9]*"))
    for p in (f"{ckpt}/commits/{last}", f"{ckpt}/commits/.{last}.crc"):  # the driver was lost before the last commit
        if os.path.exists(p):
            os.remove(p)
    assert run(ckpt) == second

    assert run(f"{root}/two") == second  # a fresh checkpoint: all ids are known, read once
    pages(spark, ("b", ["4.4", "3.3"])).coalesce(1).write.mode("append").parquet(folder)
    assert sorted((u, p) for _, u, p in run(f"{root}/two")) == [
        (URL.format("a"), 2), (URL.format("b"), 1), (URL.format("z"), 1), (URL.format("z"), 2)]


def test_state_is_keyed_and_the_store_is_not_read_by_batches(spark):
    root = scratch_path(spark, "stream-plan")
    pages(spark, ("z", ["1.1"])).write.parquet(f"{root}/pages")
    ingest.start_ingest(spark, f"{root}/pages", f"{root}/store", f"{root}/one").awaitTermination()
    q = ingest.start_ingest(spark, f"{root}/pages", f"{root}/store", f"{root}/one")
    q.awaitTermination()
    pages(spark, ("y", ["5.5"])).write.mode("append").parquet(f"{root}/pages")
    q = ingest.start_ingest(spark, f"{root}/pages", f"{root}/store", f"{root}/one")
    q.awaitTermination()
    plan = q._jsq.explainInternal(False)
    assert "TransformWithState" in plan and "/store" not in plan
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] == 2
    assert "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or "")  # set back


def test_state_holds_buckets_and_gives_whole_records(spark, monkeypatch):
    monkeypatch.setattr(ingest, "BUCKETS", 4)
    root = scratch_path(spark, "stream-buckets")
    for wave in (["1.1", 'a "q" \\ \u00e9\u4e2d', "1.1"], [f"{k}.7" for k in range(30)] + ["1.1"]):
        pages(spark, (f"w{len(wave)}", wave), ("x", wave)).coalesce(1).write.mode("append").parquet(f"{root}/pages")
        q = ingest.start_ingest(spark, f"{root}/pages", f"{root}/store", f"{root}/one", files_per_batch=1)
        q.awaitTermination()
        assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4  # not a row a fingerprint
    got = spark.read.parquet(f"{root}/store")
    late = L.extract_records(spark.read.parquet(f"{root}/pages"))
    want = S.first_wins(S.with_store_keys(late), key="_id")
    assert key(got) == key(want) and got.count() == 32
    plain = got.select(*want.columns)
    assert plain.exceptAll(want).count() == want.exceptAll(plain).count() == 0
    ingest.start_ingest(spark, f"{root}/pages", f"{root}/store", f"{root}/two").awaitTermination()  # fresh checkpoint
    assert spark.read.parquet(f"{root}/store").count() == 32


def counting(log, dim=3):
    def load():
        with open(f"{log}/loads", "a") as f:
            f.write("x\n")

        def embed(texts):
            with open(f"{log}/texts", "a") as f:
                f.writelines(t.replace("\n", "|") + "\n" for t in texts)
            assert list(map(len, texts)) == sorted(map(len, texts))
            return np.array([[len(t), t.count("a"), 1.0] for t in texts])
        return embed
    return load


def test_each_distinct_text_is_embedded_once(spark, tmp_path):
    texts = ["aa", "b", None, "", "aa", "c" * 500, "aa b"] * 30
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").repartition(6)
    out = E.batched(counting(str(tmp_path)), 3, batch=2)(df, "t", ["k"], "v").collect()
    assert {r.k: r.v for r in out} == {k: [float(len(t or "")), float((t or "").count("a")), 1.0] for k, t in enumerate(texts)}
    asked = open(f"{tmp_path}/texts").read().splitlines()
    assert sorted(asked) == sorted({t or "" for t in texts})
    known = spark.createDataFrame([(t,) for t in ("aa", "b")], "t string").select(
        F.sha2("t", 256).alias("sha"), F.array(F.lit(7.0), F.lit(7.0), F.lit(7.0)).alias("vector"))
    again = E.batched(counting(str(tmp_path)), 3, known=known)(df, "t", ["k"], "v").collect()
    assert {tuple(r.v) for r in again if texts[r.k] in ("aa", "b")} == {(7.0, 7.0, 7.0)}
    assert sorted(open(f"{tmp_path}/texts").read().splitlines()[len(asked):]) == sorted({t or "" for t in texts} - {"aa", "b"})
    with pytest.raises(Exception, match="dimension 4"):
        E.batched(counting(str(tmp_path)), 4)(df, "t", ["k"], "v").collect()


def test_embed_stream_takes_an_embedder(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"line {k % 4}\nsecond {k % 3}\n" + "w " * 30) for k in range(24)], "doc_id bigint, text string")
    store = ingest.embed_documents_stream(spark, docs, "\n", 40, embedder=E.batched(counting(str(tmp_path)), 3))
    rows = store.collect()
    from folio.operators import chunking as C
    chunks = {r.chunk_id: r.chunk for r in C.chunk_ids(C.chunk_text(docs, "text", "doc_id", "\n", 40, 0)).collect()}
    assert {r.chunk_id: r.embedding[0] for r in rows} == {i: float(len(t)) for i, t in chunks.items()}
    assert len(rows) == len(chunks) and store.select("batch_id").distinct().count() > 1
    default = ingest.embed_documents_stream(spark, docs, "\n", 40, 8)
    want = V.hash_embed(C.chunk_ids(C.chunk_text(docs, "text", "doc_id", "\n", 40, 0)), "chunk", ["chunk_id"], 8)
    assert sorted((r.chunk_id, r.embedding) for r in default.collect()) == sorted((r.chunk_id, r.embedding) for r in want.collect())
