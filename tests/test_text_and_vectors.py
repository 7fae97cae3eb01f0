import os

import numpy as np
from pyspark.sql import functions as F

from folio.operators import chunking as C
from folio.operators import store as S
from folio.operators import vectors as V
from folio.session import scratch_path


def test_chunk_fixture_f6(spark):
    docs = spark.createDataFrame([(1, 'aaaa\n\nbbbb\n\ncc'), (2, 'aaaaa\n\nbbbb'), (3, 'x' * 25), (4, '\n\n\n\n'), (5, '')],
                                 'doc_id long, text string')
    out = {}
    for r in C.chunk_text(docs, separator='\n\n', chunk_size=10).collect():
        out.setdefault(r.doc_id, []).append((r.chunk_pos, r.chunk))
    assert out == {1: [(0, 'aaaa\n\nbbbb'), (1, 'cc')], 2: [(0, 'aaaaa'), (1, 'bbbb')], 3: [(0, 'x' * 25)]}


def _loop_chunks(text, sep, size, overlap):
    """Chunks by the stated rule, on joined strings: the suffix kept is the longest one that fits."""
    chunks, held = [], []
    for piece in filter(None, text.split(sep)):
        if held and len(sep.join([*held, piece])) > size:
            chunks.append(sep.join(held))
            fits = (k for k in range(len(held)) if len(sep.join(held[k:])) <= overlap and len(sep.join([*held[k:], piece])) <= size)
            held = held[next(fits, len(held)):]
        held.append(piece)
    return [c for c in (x.strip() for x in [*chunks, sep.join(held)]) if c]


def test_chunk_overlap_matches_loop(spark):
    import random
    rnd = random.Random(3)
    texts = [' '.join(''.join(rnd.choice('abc') for _ in range(rnd.randint(1, 7))) for _ in range(rnd.randint(0, 40)))
             for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), 'doc_id long, text string')
    got = {}
    for r in C.chunk_text(docs, separator=' ', chunk_size=20, chunk_overlap=6).collect():
        got.setdefault(r.doc_id, []).append((r.chunk_pos, r.chunk))
    for i, t in enumerate(texts):
        assert [c for _, c in sorted(got.get(i, []))] == _loop_chunks(t, ' ', 20, 6)


def test_knn_fixture_f7(spark):
    vecs = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [3.0, 4.0])],
                                 'id int, embedding array<float>')
    q = spark.createDataFrame([(0, [0.0, 0.0])], 'query_id int, vector array<float>')
    got = [(r.id, r.score) for r in V.knn_topk(spark, q, vecs, k=2).orderBy('rank').collect()]
    assert got == [(1, 1.0), (2, 0.5)]


def test_dimension_assertion(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0, 2.0])], 'id int, embedding array<double>')
    try:
        V.assert_dim(df, 'embedding', 2).collect()
        assert False, 'expected failure'
    except Exception as e:
        assert 'dimension' in str(e)


def test_insert_if_absent_replay_is_idempotent(spark):
    path = scratch_path(spark, 'store-test')
    recs = spark.createDataFrame([('h1', 'p', 1, 'a'), ('h1', 'p', 0, 'b'), ('h2', 'q', 1, 'c')],
                                 'version_hash string, source_page_url string, row_pos int, doc_name string')
    assert S.insert_if_absent(spark, recs, path) == 2
    assert S.insert_if_absent(spark, recs, path) == 0
    store = spark.read.parquet(path)
    assert sorted((r._id, r.doc_name) for r in store.collect()) == [('h1', 'b'), ('h2', 'c')]
    assert S.pending_count(store).first()['count'] == 2
    S.drop_store(spark, path)
    assert S.read_store(spark, path) is None


def test_no_python_udf_in_listing_plan(spark):
    from folio.operators import listing as L
    pages = spark.createDataFrame([(1, 'https://x/dodd/', '<table class="dnnGrid"><tr></tr></table>')],
                                  'page_id long, url string, html string')
    plan = L.extract_records(pages)._jdf.queryExecution().executedPlan().toString()
    assert 'BatchEvalPython' not in plan and 'ArrowEvalPython' not in plan


def test_first_wins_limits_before_shuffle(spark):
    recs = spark.createDataFrame([('h1', 'p', 1, 'a'), ('h1', 'p', 0, 'b'), ('h2', 'q', 1, 'c')],
                                 'version_hash string, source_page_url string, row_pos int, doc_name string')
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = S.first_wins(recs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    partial = plan.index("Partial")
    assert "WindowGroupLimit" in plan and plan.index("Exchange") < partial


def test_run_stages_order(spark):
    from folio.operators.stages import run_stages
    df = spark.createDataFrame([(1,), (2,), (3,)], 'x int')
    out = run_stages(df, [(800, lambda d: d.selectExpr("x * 10 AS x")), (300, lambda d: d.where("x > 1"))])
    assert sorted(r.x for r in out.collect()) == [20, 30]


def test_knn_approx_gives_k_rows_with_recall(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 3, (12, 8))
    vecs = [(i, [float(x) for x in centres[i % 12] + rng.normal(0, .05, 8)]) for i in range(600)]
    qs = [(i, [float(x) for x in centres[i % 12] + rng.normal(0, .05, 8)]) for i in range(36)]
    qs += [(100 + i, [float(x) for x in rng.normal(0, 1, 8) + 40 * (i + 1)]) for i in range(4)]  # far from all
    v = spark.createDataFrame(vecs, "id bigint, embedding array<double>")
    q = spark.createDataFrame(qs, "query_id bigint, vector array<double>")
    k = 5
    got = {}
    for r in V.knn_approx(q, v, k=k).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.id
    exact = {}
    vm = np.array([x for _, x in vecs])
    for i, x in qs:
        exact[i] = set(np.argsort(((vm - np.array(x)) ** 2).sum(axis=1), kind="stable")[:k].tolist())
    assert set(got) == set(exact) and all(sorted(g) == list(range(1, k + 1)) for g in got.values())
    assert sum(len(set(got[i].values()) & exact[i]) for i in exact) >= 0.9 * k * len(exact)
    assert V.knn_approx(q, v.limit(3), k=k).count() == 3 * len(qs)
