"""Benchmark decontamination with suffix arrays of the training documents.

Every task cuts its documents into shards of bounded bytes and builds a word-level suffix array of each shard
by prefix doubling, ordered to the depth of a window (``WINDOW`` words; what follows cannot change a search).
Every test suffix, cut to a window, is binary-searched in every shard: the interval found holds all its places.
``longest_matches`` joins windows that follow each other on one diagonal into the longest verbatim matches.  No
document is shuffled.  The test set goes out in blocks of bounded bytes; a shard's array is built once and all blocks
are searched in it, one held at a time.  Windows with the same items share an item set, and a document's items are the
union of its sets, so a passage that many items and documents share is not multiplied out by its windows.

Words: A-Z lower-cased, then runs of digits, a-z and characters beyond U+007F.  An item of fewer words than a
window is one window.  Defined cases: null or word-free texts have no words and match nothing; a null item id
counts as the id ''; items that repeat an id count once; rows of documents that repeat are judged one by one;
other columns, of any name, pass through ``remove``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import byte_table, fresh, mix64, row_counts, slices, split_words, text_buffers, tidy, word_hashes

WINDOW = 10
UNION_CELLS = 1 << 20  # (document, item) cells expanded at a time
SHARD_BYTES = 4 << 20  # of documents in one suffix array; a longer text is a shard of its own
BLOCK_BYTES = 8 << 20  # of test texts broadcast at once
WORDS = byte_table(bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))
_PLACE = np.uint64(0x9FB21C651E98DF25)


def suffix_array(word: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Places ordered by their next ``depth`` words at least; ``left``: words to the end of the document."""
    n = len(word)
    order = np.argsort(word, kind="stable")
    step = word[order]
    first = np.append(True, step[1:] != step[:-1]) if n else np.zeros(0, bool)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n), 0)) + 1
    k = 1
    while k < depth:
        single = first & np.append(first[1:], True)
        at = np.flatnonzero(~single)
        if not len(at):
            break
        p = order[at]
        after = np.where(left[p] > k, rank[np.minimum(p + k, n - 1)], 0)
        key = rank[p] * np.int64(n + 2) + after
        o = np.argsort(key, kind="stable")
        key, p = key[o], p[o]
        order[at] = p
        new = np.append(True, key[1:] != key[:-1])
        first[at] = new
        rank[p] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))] + 1
        k *= 2
    return order


def _bound(word, left, order, lo, hi, k, want, upper: bool) -> np.ndarray:
    """First index in [lo, hi) whose k-th word is not below (or, upper, is above) ``want``; all at once."""
    lo, hi = lo.copy(), hi.copy()
    live = np.flatnonzero(lo < hi)
    while len(live):
        mid = (lo[live] + hi[live]) >> 1
        p = order[mid]
        v = np.where(left[p] > k, word[np.minimum(p + k, len(word) - 1)], 0)
        right = v <= want[live] if upper else v < want[live]
        lo[live] = np.where(right, mid + 1, lo[live])
        hi[live] = np.where(right, hi[live], mid)
        live = live[lo[live] < hi[live]]
    return lo


def search(word: np.ndarray, left: np.ndarray, order: np.ndarray, tests: np.ndarray, lens: np.ndarray):
    """(lo, hi): where each test row's first ``lens`` words lie in ``order``; 0 in ``tests`` is an unknown word."""
    n = len(tests)
    lo, hi = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    for k in range(tests.shape[1]):
        live = np.flatnonzero((lens > k) & (lo < hi))
        if not len(live):
            break
        want = tests[live, k]
        a = _bound(word, left, order, lo[live], hi[live], k, want, False)
        b = _bound(word, left, order, a, hi[live], k, want, True)
        lo[live], hi[live] = a, np.where(want == 0, a, b)
    return lo, hi


def test_windows(items: list[tuple[str, str]], window: int = WINDOW):
    """(hashes, lens, owners): distinct windows of all test suffixes; (window, item row, word) of each suffix."""
    texts = pa.array([t for _, t in items], pa.large_string())
    data, offsets = text_buffers(texts)
    low, starts, ends, rows = split_words(data, offsets, WORDS)
    h = word_hashes(low, starts, ends)
    counts = row_counts(rows, len(items))
    first = np.cumsum(counts) - counts
    place = np.arange(len(h)) - first[rows]
    use = np.flatnonzero((counts[rows] - place >= window) | ((place == 0) & (counts[rows] < window)))
    lens = np.minimum(counts[rows[use]], window)
    wins = np.zeros((len(use), window), np.uint64)
    digest = lens.astype(np.uint64)
    for k in range(window):
        has = lens > k
        wins[has, k] = h[use[has] + k]
        digest = mix64(digest * _PLACE + wins[:, k])
    _, keep, which = np.unique(digest, return_index=True, return_inverse=True)
    order = np.lexsort((rows[use], which))
    return wins[keep], lens[keep], np.stack([which[order], rows[use][order], place[use][order]], axis=1)


class Shard:
    """A slice of documents and the suffix array of its words, built once for all blocks of windows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, depth: int = 0):
        low, starts, ends, self.rows = split_words(data, offsets, WORDS)
        self.counts = row_counts(self.rows, len(offsets) - 1)
        self.first = np.cumsum(self.counts) - self.counts
        self.names, word = np.unique(word_hashes(low, starts, ends), return_inverse=True)
        self.word, self.depth = word.ravel() + 1, depth
        self.left = (self.first + self.counts)[self.rows] - np.arange(len(self.word)) if len(starts) else np.zeros(0, np.int64)

    def hits(self, wins: np.ndarray, lens: np.ndarray):
        """(place, row, window): every place (word number in its row) of a window."""
        none = np.zeros(0, np.int64)
        if not len(self.word) or not len(wins):
            return none, none, none
        if self.depth != wins.shape[1]:
            self.depth = wins.shape[1]
            self.order = suffix_array(self.word, self.left, self.depth)
        at = np.minimum(np.searchsorted(self.names, wins), len(self.names) - 1)
        tests = np.where(self.names[at] == wins, at + 1, 0)
        lo, hi = search(self.word, self.left, self.order, tests, lens)
        n = hi - lo
        window = np.repeat(np.arange(len(wins)), n)
        p = self.order[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        return p - self.first[self.rows[p]], self.rows[p], window


def merged(row: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Joined intervals of each row, ordered; touching ones are joined."""
    o = np.lexsort((start, row))
    row, start, end = row[o], start[o], end[o]
    if not len(row):
        return row, start, end
    base = row * (np.int64(max(end.max(), 1)) + 2)
    reach = np.maximum.accumulate(base + end)
    new = np.append(True, base[1:] + start[1:] > reach[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(row)) - 1
    return row[at], start[at], reach[last] - base[at]


def _lists(rows: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    off = np.append(0, np.cumsum(row_counts(rows, n)))
    return pa.ListArray.from_arrays(pa.array(off, pa.int32()), values)


def item_sets(wins: int, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(set of each window, begin of each set, items of the sets): windows with equal items share a set."""
    both = np.unique(pair[:, :2], axis=0) if len(pair) else np.zeros((0, 2), np.int64)
    begin = np.searchsorted(both[:, 0], np.arange(wins + 1))
    item = both[:, 1].astype(np.uint64)
    digest = []
    for seed in (0x51, 0xA7):  # order-free digests of each window's items: 128 bits
        total = np.append(np.uint64(0), np.cumsum(mix64(item * _PLACE ^ np.uint64(seed << 56)), dtype=np.uint64))
        digest.append(total[begin[1:]] - total[begin[:-1]])
    _, first, which = np.unique(np.stack([*digest, np.diff(begin).astype(np.uint64)], 1), axis=0, return_index=True, return_inverse=True)
    size = np.diff(begin)[first]
    ends = np.cumsum(size)
    at = np.repeat(begin[first] - (ends - size), size) + np.arange(int(size.sum()))
    return which.ravel(), np.append(0, ends), both[at, 1]


def _items_of(row: np.ndarray, sets: np.ndarray, begin: np.ndarray, items: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, item) pairs of the rows' sets, ordered; at most about UNION_CELLS cells are expanded at a time."""
    both = np.unique(np.stack([row, sets], 1), axis=0) if len(row) else np.zeros((0, 2), np.int64)
    n = begin[both[:, 1] + 1] - begin[both[:, 1]]
    out = [np.zeros(0, np.int64)]
    cuts = np.flatnonzero(np.diff(np.cumsum(n) // UNION_CELLS, prepend=0))
    for some in np.split(np.arange(len(both)), cuts):
        k = n[some]
        at = np.repeat(begin[both[some, 1]] - (np.cumsum(k) - k), k) + np.arange(int(k.sum()))
        out.append(np.unique(np.repeat(both[some, 0], k) * most + items[at]))
    cell = np.unique(np.concatenate(out))
    return cell // max(most, 1), cell % max(most, 1)


def _search(blocks: list, cols: int, text_at: int, names: list[str]):
    """Adds n_words, starts, ends, items to each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = text_buffers(b.column(text_at))
            for i, j in slices(offsets, SHARD_BYTES):
                shard = Shard(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                rows, places, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                owners, found = [np.zeros(0, np.int64)], [pa.array([], pa.string())]
                for block in blocks:
                    wins, lens, (which, begin, items), ids = block.value
                    place, row, window = shard.hits(wins, lens)
                    rows.append(row)
                    places.append(place)
                    ends.append(place + (lens[window] if len(window) else 0))
                    own, item = _items_of(row, which[window] if len(window) else window, begin, items, len(ids))
                    owners.append(own)
                    found.append(ids.take(pa.array(item)))
                    if len(blocks) > 1:  # one block is held at a time; the next use reads it from the executor's disk
                        block.__dict__.pop("_value", None)
                row, place, end = merged(*(np.concatenate(x) for x in (rows, places, ends)))
                own, ids = np.concatenate(owners), pa.concat_arrays(found).dictionary_encode()
                ranks = np.empty(len(ids.dictionary), np.int64)
                order = np.argsort(np.array(ids.dictionary.to_pylist(), dtype=object)) if len(ids.dictionary) else np.zeros(0, np.int64)
                ranks[order] = np.arange(len(order))
                cell = np.unique(own * max(len(order), 1) + ranks[ids.indices.to_numpy()])
                own, item = cell // max(len(order), 1), cell % max(len(order), 1)
                yield pa.RecordBatch.from_arrays(
                    b.slice(i, j - i).columns[:cols] + [
                        pa.array(shard.counts), _lists(row, j - i, pa.array(place, pa.int64())), _lists(row, j - i, pa.array(end, pa.int64())),
                        _lists(own, j - i, ids.dictionary.take(pa.array(order[item])).cast(pa.string()))],
                    names=names)
    return run


def _blocks(benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES):
    """The test items block by block; a block holds about ``block_bytes`` of test texts."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("i"),
                             F.col(item_text_col).alias("t")).where("t IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    blocks = 1 + size // block_bytes
    items = items.withColumn("block", F.pmod(F.xxhash64("i", "t"), F.lit(blocks)))
    for k in range(blocks):
        yield sorted((r.i, r.t) for r in items.where(F.col("block") == k).collect())


def find(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW, **options) -> tuple[DataFrame, list[str]]:
    """``docs`` with four more columns, whose names are returned: n_words, starts and ends of the joined
    intervals of hit words, and the sorted ids of the items found."""
    extra = fresh(docs.columns, "n_words", "starts", "ends", "items")
    longs = T.ArrayType(T.LongType())
    schema = T.StructType(docs.schema.fields + [T.StructField(c, k) for c, k in zip(
        extra, (T.LongType(), longs, longs, T.ArrayType(T.StringType())))])
    sc, blocks = docs.sparkSession.sparkContext, []
    for rows in _blocks(benchmark, **options):
        wins, lens, pair = test_windows(rows, window)
        blocks.append(sc.broadcast((wins, lens, item_sets(len(wins), pair), pa.array([i for i, _ in rows], pa.string()))))
    return docs.mapInArrow(tidy(_search(blocks, len(docs.columns), docs.columns.index(text_col), schema.names)), schema), extra


def assign(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """A row per input row: id, n_words, n_hit, n_items, items_sha256, contaminated.  ``find`` has the
    intervals hit, ``longest_matches`` the matches and their places."""
    found, (words, starts, ends, items) = find(docs.select(F.col(id_col), F.col(text_col)), benchmark, text_col, **options)
    total = lambda c: F.aggregate(F.col(c), F.lit(0).cast("long"), lambda a, x: a + x)
    hit = total(ends) - total(starts)
    names = F.array_sort(F.array_distinct(F.col(items)))
    return found.select(
        id_col, F.col(words).alias("n_words"), hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", names), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


def _diagonals(block):
    """(id, item, first_word, item_word, n_words) of (id, text): the longest matches with one block of items."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wins, lens, pair, ids = block.value
        span = np.searchsorted(pair[:, 0], np.arange(len(wins) + 1)) if len(wins) else np.zeros(1, np.int64)
        for b in batches:
            data, offsets = text_buffers(b.column(1))
            for i, j in slices(offsets, SHARD_BYTES):
                place, row, window = Shard(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]).hits(wins, lens)
                n = span[window + 1] - span[window] if len(window) else np.zeros(0, np.int64)
                own = pair[np.repeat(span[window] - (np.cumsum(n) - n), n) + np.arange(n.sum())] if len(window) else pair[:0]
                row, place, size = np.repeat(row, n), np.repeat(place, n), np.repeat(lens[window] if len(window) else n, n)
                o = np.lexsort((place, place - own[:, 2], own[:, 1], row))
                row, place, size, own = row[o], place[o], size[o], own[o]
                same = (row[1:] == row[:-1]) & (own[1:, 1] == own[:-1, 1]) & (place[1:] == place[:-1] + 1) & (own[1:, 2] == own[:-1, 2] + 1)
                at = np.flatnonzero(np.append(True, ~same)) if len(row) else np.zeros(0, np.int64)
                last = np.append(at[1:], len(row))[:len(at)] - 1
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i).take(pa.array(row[at])), pa.array([ids[k] for k in own[at, 1]], pa.string()),
                     pa.array(place[at]), pa.array(own[at, 2]), pa.array(place[last] + size[last] - place[at])],
                    names=["id", "item", "first_word", "item_word", "n_words"])
    return run


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    window: int = WINDOW, **options) -> DataFrame:
    """Every longest verbatim match of at least a window: id, item, first_word, item_word (both from 0), n_words."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows, out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), None
    for items in _blocks(benchmark, **options):
        block = docs.sparkSession.sparkContext.broadcast((*test_windows(items, window), [i for i, _ in items]))
        part = rows.mapInArrow(_diagonals(block), f"id {kind}, item string, first_word long, item_word long, n_words long")
        out = part if out is None else out.unionByName(part)
    return out.withColumnRenamed("id", id_col)


def remove(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` in which no window occurs."""
    found, (_, starts, _, _) = find(docs, benchmark, text_col, **options)
    return found.where(F.size(starts) == 0).select(*[F.col(f"`{c}`") for c in docs.columns])
