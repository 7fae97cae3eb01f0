"""MinHash near-duplicate removal with fast similarity sketches.

Sketch: a document's set holds its distinct ``SHINGLE``-word shingles (a shorter document is one shingle).  In
round i < ``T`` every shingle is thrown into one of ``T`` bins with a value i + u, 0 <= u < 1, and each bin keeps
its least value; in round T + j every shingle goes into bin j, so all bins fill within 2 T rounds.  A row stops
after the first round that leaves no bin empty; rows of more than T ln T shingles mostly need one.  The rows
of a bin agree with probability equal to the Jaccard similarity, with Chernoff-type bounds over bins.

Candidates: ``bands(threshold)`` bands of equally many bins.  At similarity 0.85 two documents share no band of 6 bins
with probability (1 - 0.85**6)**30 < 7e-7; for a threshold of 0.8 the bands have 5 bins, (1 - 0.8**5)**36 < 7e-7.
Documents with equal sets are one class beforehand.

Candidates are then bounded exactly: a shingle that only one candidate holds is in no intersection.  A Bloom
filter of possibly repeated shingles counts how many of a document's n shingles, c at most, others may hold; two
documents of c' = min(c1, c2) reach no more than c' / (n1 + n2 - c').  A false positive only weakens the bound.  This
removes documents that merely share a passage, and most pairs of a group that differ each in its own way.

Links are confirmed on full sets.  In a bucket, one pivot (the member with most bucket mates) is compared with all
others; linked members become one component.  A bucket is open while it holds two components.  Then the
members outside its largest component are compared with all members of other components, round by round: in
a bucket, as many of them at once as make ``PAIRS`` pairs (at least one), and more in every further round.  Few
comparisons join most of a group, the rest meet all others.  So no bucket is capped, no candidate is lost and
no group of copies is expanded into all its pairs.

Defined cases: null or word-free text has an empty set, linked with nothing.  A null id is never linked and
its row is kept.  Rows that repeat an id are one document, linked if any of their texts are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import exact_dedup
from .common import byte_table, fresh, mix64, row_counts, slices, split_words, stored, text_buffers, tidy, word_hashes

SHINGLE = 5
THRESHOLD = 85  # per cent
LEAST_THRESHOLD = 80
T = 180
PAIRS = 1 << 13  # of a bucket in the second round; eight times as many in each later one
WORDS = byte_table(b" \t\n\v\f\r")
KEY_BITS = 50  # of a shingle's hash; the upper bits of a sort key hold the row
_PLACE = np.uint64(0x9FB21C651E98DF25)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, hashes): the distinct shingles of each row, ordered by row and hash."""
    low, starts, ends, rows = split_words(data, offsets, WORDS)
    h, n = word_hashes(low, starts, ends), len(offsets) - 1
    counts = row_counts(rows, n)
    full = np.zeros(0, np.int64)
    if len(h) >= SHINGLE:
        full = np.flatnonzero(rows[SHINGLE - 1:] == rows[:len(rows) - SHINGLE + 1])
    x = np.zeros(len(full), np.uint64)
    for k in range(SHINGLE):
        x = mix64(x * _PLACE + h[full + k])
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    first = np.cumsum(counts) - counts
    y = np.zeros(len(short), np.uint64)
    for k in range(SHINGLE - 1):
        more = counts[short] > k
        y[more] = mix64(y[more] * _PLACE + h[first[short[more]] + k])
    y = mix64(y ^ (counts[short].astype(np.uint64) << np.uint64(32)))  # never equal to a full shingle's place
    key = np.concatenate([x, y]) >> np.uint64(64 - KEY_BITS)
    key |= np.concatenate([rows[full], short]).astype(np.uint64) << np.uint64(KEY_BITS)
    key.sort()
    if len(key):
        key = key[np.append(True, key[1:] != key[:-1])]
    return (key >> np.uint64(KEY_BITS)).astype(np.int64), key & np.uint64((1 << KEY_BITS) - 1)


def sketch(rows: np.ndarray, x: np.ndarray, n: int, t: int = T) -> np.ndarray:
    """Fast similarity sketches, shape (n, t); rows without shingles stay at the largest value."""
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    bins = np.full(n * t, empty)
    for i in range(2 * t):
        if not len(rows):
            break
        h = mix64(x ^ mix64(np.full(1, i + 1, np.uint64) * _PLACE))
        value = (np.uint64(i) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))
        at = ((h >> np.uint64(32)) * np.uint64(t)) >> np.uint64(32) if i < t else np.full(len(h), i - t, np.uint64)
        np.minimum.at(bins, rows * t + at.astype(np.int64), value)
        open_rows = (bins.reshape(n, t) == empty).any(axis=1)
        more = open_rows[rows]
        rows, x = rows[more], x[more]
    return bins.reshape(n, t)


def bands(threshold: int) -> int:
    """Bands at which a pair of the threshold's similarity is missed with probability below 7e-7."""
    if threshold < LEAST_THRESHOLD:
        raise ValueError(f"a threshold of {threshold} per cent is not covered, {LEAST_THRESHOLD} is the least")
    return 30 if threshold >= 85 else 36


def band_keys(bins: np.ndarray, bands: int) -> np.ndarray:
    n, t = bins.shape
    parts = bins.reshape(n, bands, t // bands)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands)).copy()
    for k in range(t // bands):
        key = mix64(key * _PLACE + parts[:, :, k])
    return key


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        data, offsets = text_buffers(b.column(1))
        for i, j in slices(offsets):
            _, x = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays([pa.array(mix64(x).view(np.int64))], names=["h"])


def _shared(filt, bits: int):
    """(id, n, shared): size of the set and how many of its shingles another document may hold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            for i, j in slices(offsets):
                rows, x = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                hit = exact_dedup.in_filter(mix64(x), filt.value, bits)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(row_counts(rows, j - i)), pa.array(row_counts(rows[hit], j - i))],
                    names=["id", "n", "shared"])
    return run


def _reachable(n1, c1, n2, c2, threshold: int):
    """Whether two sets can reach the threshold, by their sizes and shared shingles."""
    c = F.least(c1, c2)
    return 100 * c >= threshold * (n1 + n2 - c)


def _sketches(bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            for i, j in slices(offsets):
                rows, x = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                n = j - i
                size = row_counts(rows, n)
                one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                ends = np.cumsum(size)
                for out, seed in ((one, 0x51), (two, 0xA7)):  # order-free digest of the set: 128 bits
                    total = np.append(np.uint64(0), np.cumsum(mix64(x ^ np.uint64(seed << 56)), dtype=np.uint64))
                    out[:] = total[ends] - total[ends - size]
                keys = band_keys(sketch(rows, x, n), bands).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(size), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                     pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), bands).cast(pa.list_(pa.int64()))],
                    names=["id", "n", "s1", "s2", "bands"])
    return run


def _confirm(threshold: int):
    """Of (a, b, text_a, text_b), the pairs whose full sets reach the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            (da, oa), (db, ob) = text_buffers(b.column(2)), text_buffers(b.column(3))
            keep = np.zeros(b.num_rows, bool)
            for i, j in slices(oa + ob):
                (ra, xa), (rb, xb) = (shingle_sets(d[o[i]:o[j]], o[i:j + 1] - o[i]) for d, o in ((da, oa), (db, ob)))
                na, nb = row_counts(ra, j - i), row_counts(rb, j - i)
                key = np.sort(np.concatenate([ra.astype(np.uint64) << np.uint64(KEY_BITS) | xa,
                                              rb.astype(np.uint64) << np.uint64(KEY_BITS) | xb]))
                same = key[1:][key[1:] == key[:-1]]
                both = row_counts((same >> np.uint64(KEY_BITS)).astype(np.int64), j - i)
                keep[i:j] = (100 * both >= threshold * (na + nb - both)) & (na > 0) & (nb > 0)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(keep)), b.column(1).filter(pa.array(keep))],
                                             names=["a", "b"])
    return run


def components(links: DataFrame) -> DataFrame:
    """(id, comp): the least id reachable, for every id in ``links`` (a, b), which is a stored table.

    Each round hands every node the least label around it and then jumps to that label's own label; rounds
    grow with the logarithm of a component's diameter, and each is two joins and one partial aggregate.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = stored(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "label")
    while True:
        near = (both.join(label, both["b"] == label["id"]).groupBy(F.col("a").alias("id")).agg(F.min("comp").alias("near")))
        step = label.join(near, "id").select("id", F.least("comp", "near").alias("next"), F.col("comp").alias("was"))
        up = label.select(F.col("id").alias("next"), F.col("comp").alias("far"))
        new = stored(step.join(up, "next").select("id", F.least("next", "far").alias("comp"), "was"), "label")
        label = new.select("id", "comp")
        if new.where("comp <> was").isEmpty():
            return label


def _ids_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of pairs, each once a batch: no shuffle, and an id of many pairs is few rows."""
    for b in batches:
        yield pa.RecordBatch.from_arrays([pc.unique(pa.concat_arrays([b.column(0), b.column(1)]))], names=["id"])


def _links(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """Confirmed pairs; only texts of documents that are in a pair are dealt out."""
    ids = stored(pairs.mapInArrow(tidy(_ids_of), f"id {pairs.schema['a'].dataType.simpleString()}"), "pair-ids")
    texts = texts.join(ids, "id", "left_semi")
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    full = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return full.mapInArrow(tidy(_confirm(threshold)), pairs.select("a", "b").schema)


def _texts_of(texts: DataFrame, ids: DataFrame) -> tuple[DataFrame, int]:
    """The texts of ``ids`` and few others, without a shuffle of texts, and how many ids there are.

    A Bloom filter holds the ids (each is put in twice); a text too many only weakens a bound."""
    count = ids.count()
    bits = exact_dedup.filter_bits(2 * count)
    twice = ids.select(F.explode(F.array(F.xxhash64("id"), F.xxhash64("id"))).alias("h"))
    filt = exact_dedup.repeated_filter(twice, bits)
    return stored(texts.where(exact_dedup.possibly_repeated(F.xxhash64("id"), filt, bits)), "texts"), count


def _open_buckets(bucket: DataFrame, comp: DataFrame, reps: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of buckets with two components or more, those outside the largest component, and all as partners."""
    state = (bucket.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
             .select("key", "band", "id", "comp", "score", "n", "shared"))
    per = state.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m"))
    main = (per.groupBy("key").agg(F.max(F.struct("m", "comp")).getField("comp").alias("main"), F.sum("m").alias("all"),
                                   F.count(F.lit(1)).alias("parts")).where("parts > 1"))
    state = stored(state.join(main, "key").join(reps.select("id", "bands"), "id"), "state")
    other = state.select("key", F.col("id").alias("other"), F.col("comp").alias("other_comp"), F.col("n").alias("n2"),
                         F.col("shared").alias("shared2"), F.col("bands").alias("bands2"))
    return state, state.where("comp <> main"), other


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """A row per input row: id, n_shingles, component_id (least id reachable), kept (id = component_id)."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = texts.schema["id"].dataType.simpleString()
    made = stored(texts.mapInArrow(tidy(_sketches(bands(threshold))), f"id {kind}, n long, s1 long, s2 long, bands array<long>"), "sketch")
    reps = stored(made.where("n > 0 AND id IS NOT NULL").groupBy("s1", "s2", "n")
                  .agg(F.min(F.struct("id", "bands")).alias("r")).select("s1", "s2", "n", "r.*"), "reps")
    # one id may stand for several sets: its label joins them
    member = made.where("n > 0 AND id IS NOT NULL").select("id", "s1", "s2", "n")
    all_bands = reps.select("id", F.posexplode("bands").alias("band", "key"))
    sizes = all_bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    bucket = stored(all_bands.join(sizes, "key").distinct(), "mates")
    score = bucket.groupBy("id").agg(F.sum("size").alias("score"))
    texts, count = _texts_of(texts, score.select("id"))
    bits = exact_dedup.filter_bits(int(2 * count * (reps.agg(F.avg("n")).first()[0] or 0)))  # room for twice the mean
    filt = exact_dedup.repeated_filter(texts, bits, _shingle_rows)
    shared = (texts.mapInArrow(tidy(_shared(filt, bits)), f"id {kind}, n long, shared long").groupBy("id")
              .agg(F.min("n").alias("n"), F.max("shared").alias("shared")).where(100 * F.col("shared") >= threshold * F.col("n")))
    bucket = stored(bucket.join(score.join(shared, "id"), "id"), "bucket")

    pivot = (bucket.groupBy("key").agg(F.max(F.struct("score", "id", "n", "shared")).alias("p"))
             .select("key", F.col("p.id").alias("pivot"), F.col("p.n").alias("n2"), F.col("p.shared").alias("shared2")))
    alike = _reachable(F.col("n"), F.col("shared"), F.col("n2"), F.col("shared2"), threshold)
    todo = (bucket.join(pivot, "key").where((F.col("id") != F.col("pivot")) & alike)
            .select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct())
    # a pair is met in the first band that it shares
    first = ~F.arrays_overlap(F.slice("bands", F.lit(1), F.col("band")), F.slice("bands2", F.lit(1), F.col("band")))
    todo, seen, links, done, budget = stored(todo, "pairs"), None, None, None, PAIRS
    while True:
        found = stored(_links(todo, texts, threshold), "confirmed")
        seen = todo if seen is None else seen.unionByName(todo)
        if links is None or not found.isEmpty():  # else all components are as before
            links = found if links is None else links.unionByName(found)
            comp = components(links)
            state, outside, other = _open_buckets(bucket, comp, reps)
        todo = None
        while todo is None:  # turns whose pairs have all been seen need no new components
            left = outside if done is None else outside.join(done, ["key", "id"], "left_anti")
            w = Window.partitionBy("key").orderBy(F.desc("score"), "id")
            turn = stored(left.withColumn("turn", F.row_number().over(w)).select("key", "id", "comp", "all", "turn", "n", "shared", "band", "bands")
                          .where((F.col("turn") == 1) | (F.col("turn") * F.col("all") <= budget)), "turn")
            budget *= 8
            if turn.isEmpty():
                break
            done = turn.select("key", "id") if done is None else done.unionByName(turn.select("key", "id"))
            todo = (turn.join(other, "key").where((F.col("comp") != F.col("other_comp")) & alike & first)
                    .select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct())
            todo = stored(todo.join(seen, ["a", "b"], "left_anti"), "pairs")
            if todo.isEmpty():
                todo = None
        if todo is None:
            break

    # a document's class, its representative's component, and documents that repeat an id
    rep = reps.select("s1", "s2", "n", F.col("id").alias("rep")).join(
        comp.select(F.col("id").alias("rep"), "comp"), "rep", "left").select(
        "s1", "s2", "n", F.coalesce("comp", "rep").alias("comp"))
    placed = member.join(rep, ["s1", "s2", "n"]).groupBy("id").agg(F.min("comp").alias("comp"))
    out = made.select("id", "n").join(placed, "id", "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("comp", "id").alias("component_id"))
    return out.withColumn("kept", F.col("id").isNull() | F.col("id").eqNullSafe(F.col("component_id"))).withColumnRenamed("id", id_col)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: of each component, those with its least id."""
    gone, = fresh(docs.columns, "gone")
    drop = assign(docs, id_col, text_col, threshold).where("NOT kept").select(F.col(id_col).alias(gone)).distinct()
    return docs.join(drop, docs[id_col] == F.col(gone), "left_anti")
