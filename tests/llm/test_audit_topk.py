"""Filter interaction audit and exact top-k search against plain loops."""

import random
import re
from itertools import permutations

import numpy as np
import pytest

from folio.llm import filter_audit, topk

DOCS = "doc_id long, text string, source string, `row` int, PART string, sha string"


def audit_brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    fails = []
    for i, t, part, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {f for f, c in (("A", len(w) < 50), ("B", 100 * len(set(w)) < 65 * len(w)),
                              ("C", 100 * len(re.findall("[A-Z]", t)) > 5 * len(t)), ("D", re.search("[#$%&*|]", t)),
                              ("E", i is not None and least[t] < i)) if c}
        fails.append((i, part or "", bad))
    out = {}
    for part in {p for _, p, _ in fails}:
        mine = [(i, b) for i, p, b in fails if p == part]
        for order in permutations("ABCDE"):
            for k, f in enumerate(order):
                before = set(order[:k])
                removed = [i for i, b in mine if f in b and not b & before]
                out[part, "".join(order), k + 1] = [
                    sum(not b & (before | {f}) for _, b in mine), len(removed), sum(f in b and bool(b & before) for _, b in mine),
                    sum(b == {f} for _, b in mine), sum(i in good for i in removed), sum(i in toxic for i in removed)]
    for part in {p for _, p, _ in fails}:
        for f in "ABCDE":
            mine = [k for k in out if k[0] == part and k[1][k[2] - 1] == f]
            total = sum(out[k][1] for k in mine)
            for k in mine:
                out[k].append(total)
    return {k: tuple(v) for k, v in out.items()}


def audit_rows():
    rng = random.Random(4)
    rows = []
    for k in range(90):
        n = rng.choice([3, 49, 50, 60, 80])
        words = [rng.choice("abcdefghij") if rng.random() < rng.choice([0.1, 0.6]) else f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
        if rng.random() < 0.3:
            words[0] = rng.choice(["#", "a|b", "100%"])
        if rng.random() < 0.3:
            words = [w.upper() for w in words]
        text = rng.choice([" ", "\t", "\x0b \n"]).join(words)
        rows.append((k, text, rng.choice(["s", "t", None, ""]), k, "p", "x"))
    for k in range(90, 120):  # copies, also under a smaller id's text
        rows.append((k, rows[rng.randrange(60)][1], rng.choice(["s", "t"]), 0, "p", None))
    rows += [(200, None, "s", 0, None, None), (201, "", "s", 0, None, None), (None, rows[0][1], "t", 0, "", ""),
             (None, None, None, None, None, None), rows[5], rows[95], (5, "other text", "s", 0, "", ""),
             (300, "é" * 10 + " " + " ".join(f"x{i}" for i in range(200000)), "u", 0, "", "")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in range(0, 120, 2)] + [(4, 1, 0), (None, 1, 1)]
    return rows, labels


def test_audit_against_brute_force(spark):
    rows, labels = audit_rows()
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    got = filter_audit.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    want = audit_brute(rows, labels)
    assert len(got) == len(want)
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got} == want


def test_audit_of_empty_tables(spark):
    rows, _ = audit_rows()
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark.createDataFrame([], DOCS), none).count() == 0
    got = filter_audit.audit(spark.createDataFrame(rows[:20], DOCS), none)
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in got.collect()} == audit_brute(rows[:20], [])


VECTORS = "vec_id long, embedding array<float>, score int, shard int"


def topk_brute(queries, rows, k):
    def usable(r):
        return r[0] is not None and r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])

    def whole(v):
        return [int(np.floor(1024.0 * float(np.float32(x)))) for x in v]

    cand = [(i, whole(v)) for i, v in {id(r): r[:2] for r in rows if usable(r)}.values()]
    out = {}
    for q, v in {(r[0], tuple(r[1])) for r in queries if usable(r)}:
        v = whole(v)
        out[q] = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in cand if i != q)[:k]
    return {(q, n + 1): (i, -s) for q, best in out.items() for n, (s, i) in enumerate(best)}


def run_topk(spark, queries, rows, **options):
    q, v = (spark.createDataFrame([tuple(r[:2]) + (0, 0) for r in x], VECTORS) for x in (queries, rows))
    got = topk.search(q, v.repartition(3), **options).collect()
    assert len({(r.query_id, r.rank) for r in got}) == len(got)
    return {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got}


@pytest.mark.parametrize("shard_rows", [40, 10 ** 6])
def test_topk_clusters_copies_and_odd_rows(spark, shard_rows):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(6, 8)) * 3
    rows = [(int(i), [float(x) for x in centres[i % 6] + rng.normal(size=8) * 0.1]) for i in range(700)]
    rows += [(1000 + i, [0.5] * 8) for i in range(300)]  # one vector very often: ties by id
    rows += [(2000, None), (2100, [None] + [1.0] * 7), (2200, [float("nan")] * 8), (2300, [float("inf")] * 8), (None, [9.0] * 8),
             (2400, []), (2500, [1.0]), (2600, [0.1] * 11), (7, rows[7][1])]
    queries = [r for r in rows if r[0] is not None and r[0] % 100 == 0]
    assert run_topk(spark, queries, rows, k=10, shard_rows=shard_rows) == topk_brute(queries, rows, 10)


def test_topk_few_candidates_and_empty(spark):
    rows = [(0, [1.0, 2.0]), (100, [-3.0, 0.25]), (5, [0.0, 0.0])]
    assert run_topk(spark, rows[:2], rows, k=10) == topk_brute(rows[:2], rows, 10)
    assert run_topk(spark, [], rows) == {} and run_topk(spark, rows, []) == {}
    assert run_topk(spark, rows[:1] * 3, rows, k=2) == topk_brute(rows[:1], rows, 2)


def test_topk_beyond_exact_doubles(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=4) * 4e4]) for i in range(400)]
    queries = rows[::50]
    assert run_topk(spark, queries, rows, shard_rows=150) == topk_brute(queries, rows, 10)
    with pytest.raises(Exception, match="64 bits"):
        run_topk(spark, [(1, [1e30] * 4)], [(2, [1e30] * 4)])


def test_ball_bounds_hold_and_prune():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 6)) * 4000
    x = np.floor(centres[rng.integers(20, size=3000)] + rng.normal(size=(3000, 6)) * 20)
    tree = topk.BallTree(np.arange(3000), x)
    q = x[:50]
    norms = np.sqrt((q ** 2).sum(1))
    b = tree.bounds(q, norms, np.arange(len(tree.begin)))
    for n in range(len(tree.begin)):
        s = q @ tree.vectors[tree.begin[n]:tree.end[n]].T
        assert (s.max(1) <= b[:, n]).all()
    leaves = np.flatnonzero(tree.children[:, 0] < 0)
    best = np.sort(q @ x.T, 1)[:, -10]
    assert (b[:, leaves] >= best[:, None]).mean() < 0.3  # most leaves hold nothing for a query
