"""Exact and near dedup and decontamination against brute force on small tables."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from folio.llm import decontam, exact_dedup, near_dedup

SCHEMA = "doc_id long, text string, lang string, MAYBE string, n_words long"


def lower(x):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), x)


def words(rng, n):
    return [rng.choice(["alpha", "Beta", "gamma", "delta", "é", "x1", "zeta", "eta,", "theta"]) for _ in range(n)]


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    base = words(rng, 120)
    rows = []
    for k in range(n):
        kind = k % 6
        if kind == 0:
            text = " ".join(base)
        elif kind == 1:
            w = list(base)
            w[rng.randrange(len(w))] = f"new{rng.randrange(5)}"
            text = " ".join(w)
        elif kind == 2:
            text = " ".join(words(rng, rng.randrange(1, 8)))
        elif kind == 3:
            text = rng.choice([None, "", " \t\n", "!!! ...", "one"])
        elif kind == 4:
            text = " ".join(f"u{k}_{i}" for i in range(rng.randrange(1, 40)))
        else:
            text = "Beta\tgamma \n".join(words(rng, 3)) + " tail"
        rows.append((k, text, "en", "m", k))
    rows.append((n, " ".join(f"w{i % 997}" for i in range(30000)), "en", "m", 0))  # very long
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(5)


def test_exact_assign(docs):
    rows = corpus()
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault(t or "", []).append(d)
    got = {r.doc_id: tuple(r) for r in exact_dedup.assign(docs).collect()}
    assert len(got) == len(rows)
    for d, t, *_ in rows:
        g = groups[t or ""]
        assert got[d] == (d, max(g), len(g), d == max(g), hashlib.sha256((t or "").encode()).hexdigest())


@pytest.mark.parametrize("bits", [1 << 16, 1 << 20])
def test_exact_dedup_keeps_columns(docs, bits):
    out = exact_dedup.dedup(docs, max_bits=bits)
    assert out.columns == docs.columns
    last = {t or "": d for d, t, *_ in corpus()}
    assert sorted(r.doc_id for r in out.collect()) == sorted(last.values())


def test_exact_nulls_and_repeated_rows(spark):
    rows = [(None, "a", "x", "p", 1), (None, "a", "x", "p", 1), (3, "a", "x", None, 1), (3, "a", "x", None, 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted((r.doc_id or -1, r.text or "") for r in exact_dedup.dedup(df).collect()) == [(-1, ""), (3, "a")]
    assert sorted((r.doc_id is None, r.kept, r.group_size) for r in exact_dedup.assign(df).collect()) == [
        (False, True, 4), (False, True, 4), (True, False, 4), (True, False, 4), (True, True, 1)]
    empty = df.limit(0)
    assert exact_dedup.assign(empty).count() == 0 and exact_dedup.dedup(empty).count() == 0


def test_filter_misses_no_repeated_hash(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 1000).cast("string").alias("text"))
    for bits in (1 << 16, 1 << 18):
        filt = exact_dedup.repeated_filter(df.select(F.xxhash64("text").alias("h")), bits)
        assert df.where(~exact_dedup.possibly_repeated(F.xxhash64("text"), filt, bits)).count() == 0


def near_brute(rows, threshold=85):
    sets = {}
    for d, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
        sets[d] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    comp = {d: d for d in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a < b and both and 100 * both >= threshold * len(sets[a] | sets[b]) and comp[a] != comp[b]:
                    comp[a] = comp[b] = min(comp[a], comp[b])
                    changed = True
    return {d: (len(s), comp[d]) for d, s in sets.items()}


@pytest.mark.parametrize("threshold", [80, 85])
def test_near_against_brute_force(docs, threshold):
    want = near_brute(corpus(), threshold)
    got = near_dedup.assign(docs, threshold=threshold).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    kept = near_dedup.dedup(docs, threshold=threshold)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, (_, c) in want.items() if c == d)


def test_near_chains_and_small_pair_budget(spark, monkeypatch):
    """Links in a chain are all found, also when a bucket needs several rounds."""
    monkeypatch.setattr(near_dedup, "PAIRS", 1)
    rng = random.Random(5)
    w = [f"t{rng.randrange(10 ** 6)}" for _ in range(200)]
    rows = []
    for k in range(24):
        w = list(w)
        w[(k * 7) % 200] = f"c{k}"
        rows.append((100 - k, " ".join(w), "en", "m", k))
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.assign(df).collect()} == near_brute(rows)


def test_near_nulls_ties_empty(spark):
    text = " ".join(f"a{k}" for k in range(30))
    rows = [(None, text, "x", "p", 1), (7, text, "x", "p", 1), (7, text, "x", "p", 1), (9, text + " b", "x", "p", 1), (8, None, "x", "p", 1)]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept)
                 for r in near_dedup.assign(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(-1, 26, -1, True), (7, 26, 7, True), (7, 26, 7, True), (8, 0, 8, True), (9, 27, 7, False)]
    assert near_dedup.assign(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sketch_fills_every_bin():
    import numpy as np
    rows = np.repeat(np.arange(3), [1, 5, 4000])
    x = np.arange(4006, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(14)
    bins = near_dedup.sketch(rows, x, 4)
    assert (bins[:3] != np.uint64(0xFFFFFFFFFFFFFFFF)).all() and (bins[3] == np.uint64(0xFFFFFFFFFFFFFFFF)).all()


WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination_brute(rows, items):
    owners = {}
    for i, t in items:
        w = WORD.findall(lower(t or ""))
        for k in range(max(1, len(w) - 9) if w else 0):
            owners.setdefault(tuple(w[k:k + 10]), set()).add("" if i is None else str(i))
    out = {}
    for d, t, *_ in rows:
        w = WORD.findall(lower(t or ""))
        hit, found = set(), set()
        for n in {len(k) for k in owners}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in owners:
                    found |= owners[tuple(w[k:k + n])]
                    hit |= set(range(k, k + n))
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def items():
    rng = random.Random(3)
    long = [(k, " ".join(words(rng, 14))) for k in range(8)]
    planted = corpus()[0][1].upper().split()
    return long + [(20, " ".join(planted[5:17])), (21, " ".join(planted[100:120])), (22, "x1 zeta"), (23, None), (24, "..."), (None, "w5 W6 w7"), (23, "tail")]


@pytest.mark.parametrize("block", [1 << 20, 100])
def test_decontamination(spark, docs, block):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    got = decontam.assign(docs, bench, block_bytes=block).collect()
    want = contamination_brute(corpus(), items())
    assert {r.doc_id: tuple(r)[1:] for r in got} == want
    left = decontam.remove(docs, bench, block_bytes=block)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, x in want.items() if not x[-1])


def test_longest_matches(spark):
    text = " ".join(f"w{k}" for k in range(50))
    docs = spark.createDataFrame([(1, "pre fix " + text + " end"), (2, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(5, " ".join(f"W{k}" for k in range(10, 45)))], "item_id long, text string")
    assert [tuple(r) for r in decontam.longest_matches(docs, bench).collect()] == [(1, "5", 12, 0, 35)]


def test_decontamination_empty(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.remove(docs, none).count() == docs.count()
    assert decontam.assign(docs.limit(0), none).count() == 0


def test_suffix_array_order():
    import numpy as np
    rng = np.random.default_rng(0)
    word = rng.integers(1, 4, 300)
    left = 300 - np.arange(300)
    order = decontam.suffix_array(word, left, 16)
    keys = [tuple(word[p:p + 16]) for p in order]
    assert keys == sorted(keys) and sorted(order) == list(range(300))


def test_decontam_in_blocks_and_shared_windows(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA).repartition(3)
    bench = spark.createDataFrame(items(), "item_id long, text string")
    want = contamination_brute(corpus(), items())
    for size in (1, 200):  # many blocks, searched in one pass
        got = decontam.assign(docs, bench, block_bytes=size)
        assert {r.doc_id: tuple(r)[1:] for r in got.collect()} == want
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1


def test_decontam_of_a_popular_passage(spark):
    import time
    shared = " ".join(f"s{k}" for k in range(12))
    docs = spark.createDataFrame([(k, f"own{k} {shared} tail{k}") for k in range(1000)], "doc_id long, text string").repartition(1)
    bench = spark.createDataFrame([(k, f"{shared} q{k}") for k in range(2000)], "item_id long, text string")
    begin = time.time()
    got = decontam.assign(docs, bench).select("n_hit", "n_items").distinct().collect()
    assert [tuple(r) for r in got] == [(12, 2000)] and time.time() - begin < 60


def test_near_threshold_below_the_least_is_an_error(docs):
    with pytest.raises(ValueError, match="least"):
        near_dedup.assign(docs, threshold=79)


def test_texts_of_pairs_are_found_without_a_shuffle_of_ids(spark, monkeypatch):
    words = [f"w{k}" for k in range(40)]
    docs = {k: " ".join(words[:40 - (k == 3) * 30] + [f"end{k}"]) for k in range(6)}
    texts = spark.createDataFrame([*docs.items(), (None, "no id"), (9, "in no pair")], "id long, text string")
    pairs = spark.createDataFrame([(0, k) for k in range(1, 6)] + [(1, 2)], "a long, b long").coalesce(1)
    plans, stored = [], near_dedup.stored

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().toString()))
        return stored(df, name)
    monkeypatch.setattr(near_dedup, "stored", watched)
    got = sorted(tuple(r) for r in near_dedup._links(pairs, texts, 85).collect())
    assert got == [(0, 1), (0, 2), (0, 4), (0, 5), (1, 2)]
    (name, plan), = plans
    assert name == "pair-ids" and "Aggregate" not in plan and "hashpartitioning" not in plan
