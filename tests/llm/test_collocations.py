"""Phrase mining against plain loops, over small blocks and tiles, with and without broadcast dictionaries."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from folio.llm import collocations as C

DOCS = "doc_id long, text string, lang string, phrase string, rank int, words int"


def lower(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t)


def brute(rows, least, longest=5, top=2000):
    n, f = Counter(), {}
    for _, t, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", lower(t or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                for k in range(len(w) - m + 1):
                    f.setdefault(lang, Counter())[tuple(w[k:k + m])] += 1
    out = []
    for lang, own in f.items():
        cand = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in cand.items():
            for z in range(2, len(p)):
                for b in range(len(p) - z + 1):
                    longer[p[b:b + z]] = max(longer[p[b:b + z]], a)
        mine = []
        for p, a in cand.items():
            score, _, l, r = min((1000 * a * n[lang] // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            if longer[p] < a:
                mine.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def rows():
    rng = random.Random(11)
    names = ["The", "the", "of", "a", "b", "état", "x1", "né-", "“q”", " z", "rare"] + [f"w{k}" for k in range(60)]
    out = []
    for k in range(160):
        words = [rng.choices(names, [12, 9, 8, 6, 5, 4, 3, 3, 2, 2, 0.2] + [0.4] * 60)[0] for _ in range(rng.randrange(1, 90))]
        text = "".join(w + rng.choice([" "] * 8 + ["\t", ". ", ",", "\n", "\r\n", "!? ", " \x0b", "  "]) for w in words)
        if k % 4 == 0:
            text += rng.choice([" New York City Hall Park", ". ping ping ping ping ping ping"]) * rng.randrange(1, 4)
        out.append((k, text, rng.choice(["en", "en", "fr", None, "und"]), "p", 1, 2))
    out += [(200, None, "en", None, None, None), (201, "", "en", "", 0, 0), (202, " ..!\n", "fr", "", 0, 0), out[0], out[0], out[4],
            (203, "new york " * 20000, "de", "", 0, 0), (204, "y" * 100000 + " z", "en", "", 0, 0)]
    return out


@pytest.mark.parametrize("least,options", [
    (6, {}),
    (3, {"block_bytes": 700, "broadcast_bytes": 0, "tile": 4}),
])
def test_against_brute_force(spark, least, options):
    docs = spark.createDataFrame(rows(), DOCS).repartition(3)
    got = sorted(tuple(r) for r in C.mine(docs, least=least, **options).collect())
    want = brute(rows(), least)
    assert len({r[0] for r in want}) >= 4 and len(want) > 50
    assert got == want


def test_top_and_ties(spark):
    text = " . ".join(f"p{k} q{k}" for k in range(30)) + " "
    docs = spark.createDataFrame([(k, text, "en", "", 0, 0) for k in range(5)], DOCS)
    got = sorted(tuple(r) for r in C.mine(docs, least=5, top=7).collect())
    assert got == brute([(k, text, "en") for k in range(5)], 5, top=7) and len(got) == 7


def test_no_phrases_and_empty(spark):
    assert C.mine(spark.createDataFrame([], DOCS)).count() == 0
    assert C.mine(spark.createDataFrame(rows()[:3], DOCS), least=10 ** 6).count() == 0


def test_tiles_count_as_a_dictionary(monkeypatch):
    monkeypatch.setattr(C, "SPARSE_CELLS", 500)
    rng = np.random.default_rng(1)
    counter, want = C.TileCounter(tile=8, dense_tiles=3), Counter()
    got = Counter()
    for _ in range(20):
        x, y = (rng.zipf(1.3, 3000).clip(0, 2 ** 31 - 1).astype(np.int64) - 1 for _ in range(2))
        codes = x << 32 | y
        want.update(codes.tolist())
        counter.add(codes)
        if counter.full():
            for c, n in counter.take():
                got.update(dict(zip(c.tolist(), n.tolist())))
    assert len(counter.dense) <= 3
    for c, n in counter.take():
        got.update(dict(zip(c.tolist(), n.tolist())))
    assert got == want


def batches_of(rng, langs, blocks, size, most):
    """(batches of (lang, seq), pairs by language); runs of numbers are cut by -1 here and there."""
    out, want = [], {lang: Counter() for lang in langs}
    for k in range(blocks):
        seq = np.where(rng.random(size) < 0.1, -1, rng.zipf(1.2, size) % most).astype(np.int32)
        lang = langs[k % len(langs)]
        good = (seq[:-1] >= 0) & (seq[1:] >= 0)
        want[lang].update((seq[:-1].astype(np.int64) << 32 | seq[1:])[good].tolist())
        out.append(pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([seq.tobytes()], pa.binary())], names=["lang", "seq"]))
    return out, want


def test_pairs_travel_as_packets(monkeypatch):
    """Few rows go to the exchange, not one a pair; merged by bucket they give each frequent pair its count."""
    for name, value in (("SPARSE_CELLS", 4000), ("PACKED_CELLS", 1500), ("BATCH_PAIRS", 777), ("PACKET_BYTES", 5000)):
        monkeypatch.setattr(C, name, value)
    batches, want = batches_of(np.random.default_rng(2), ["en", "fr", "né"], 9, 5000, 400)
    rows = [r for b in C._count_pairs(16, 7)(iter(batches)) for r in b.to_pylist()]
    assert {r["bucket"] for r in rows} == set(range(7)) and 50 * len(rows) < 9 * 5000
    rows.sort(key=lambda r: (r["lang"], r["bucket"]))
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("cells", pa.binary())])
    sent = [pa.RecordBatch.from_pylist(rows[a:a + 5], schema) for a in range(0, len(rows), 5)]
    for least in (1, 6):
        got = [(r["lang"], r["code"], r["f"]) for b in C._merge_packets(least)(iter(sent)) for r in b.to_pylist()]
        assert sorted(got) == sorted((lang, c, f) for lang, own in want.items() for c, f in own.items() if f >= least)
    assert list(C._merge_packets(1)(iter([]))) == []


def test_packets_keep_large_numbers():
    codes = np.array([0, 5, (2 ** 31 - 1) << 32 | 7, (2 ** 31 - 1) << 32 | 2 ** 31 - 1], np.int64)
    counts = np.array([1, 2 ** 40, 255, 256], np.int64)
    for n in range(1, 5):
        got = C._unpacked(C._packed(codes[:n], counts[:n]))
        assert [x.tolist() for x in got] == [codes[:n].tolist(), counts[:n].tolist()]


def test_pairs_are_counted_in_little_memory(spark):
    """Blocks of 700,000 words are counted in parts, and no table of pairs is kept by the JVM."""
    batches, _ = batches_of(np.random.default_rng(3), ["de", "en", "es", "fr"], 4, 700_000, 20_000)
    tracemalloc.start()
    try:
        for _ in C._count_pairs(C.TILE, 50)(iter(batches)):
            pass
        assert tracemalloc.get_traced_memory()[1] < 50 << 20
    finally:
        tracemalloc.stop()
    level = spark.createDataFrame([(1, "en", b"")], C.SEQ)
    assert "Aggregate" not in C._frequent_pairs(level, 2, C.TILE, 10)._jdf.queryExecution().executedPlan().toString()


def test_a_block_of_many_texts(monkeypatch):
    """A block is read in slices; pieces end with each text and each stop, also where a slice ends."""
    texts = [" A b", "c. d  e", None, "", "é f\x0bg", "h"]
    whole = C._block_of([pa.array(texts)])
    monkeypatch.setattr(C, "slices", lambda offsets: ((k, k + 1) for k in range(len(offsets) - 1)))
    for parts in ([pa.array(texts)], [pa.array(texts[:1]), pa.array(texts[1:4]), pa.array(texts[4:])]):
        words, counts, seq = C._block_of(parts)
        assert words.to_pylist() == whole[0].to_pylist() == ["a", "b", "c", "d", "e", "é", "f", "g", "h"]
        assert counts.tolist() == [1] * 9 and seq.tolist() == whole[2].tolist() == [0, 1, -1, 2, -1, 3, 4, -1, 5, 6, -1, 7, -1, 8]
