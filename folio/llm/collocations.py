"""Phrase collocation mining: exact counts of frequent phrases by direct-address tiling.

1. Texts are cut into blocks of one language.  A block is stored as its distinct words and a sequence of their
   local numbers, with -1 between pieces; later steps never see text again.
2. Words that occur ``least`` times are ranked by frequency.  Blocks are stored as sequences of ranks, with -1
   for every other word (a phrase is at most as frequent as its parts).
3. Pairs of neighbours in the sequences are counted.  A pair (i, j) of ranks lies in the tile (i // TILE, j // TILE).
   Since ranks follow frequency, a few tiles hold most pairs: they are counted by ``bincount`` straight into an array of
   TILE x TILE cells, the rest as sorted (code, count) lists.  A task holds a bounded number of cells.  It sends its counts on in
   packets, one for each bucket of hashed codes, and a task that receives a bucket merges its packets: the JVM moves some
   thousand rows and never keeps a table of pairs.  There are as many buckets as keep each of them small.
4. Frequent pairs are ranked in turn and replace the ranks in the sequences: the pair at a place and the pair at
   the next one are a phrase of three words, and so on up to ``longest`` words.

Dictionaries (word or pair to rank) go to tasks as a broadcast only when their size, known by then, is at most
``broadcast_bytes``; larger ones are joined with each block's distinct words or pairs, and come back by block.

A word's or pair's count is summed after partial aggregation; a language with most of the rows is many blocks.
Products are decimals of 38 digits: exact up to 1000 * a * n = 10**38.

Defined cases: null text is empty, null language ``und``.  Repeated rows count each.  Of equal scores and counts
the phrase smaller in UTF-8 bytes comes first.  A table without phrases gives no rows.  Other columns are disregarded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix64, release_memory, slices, split_words, stored, text_buffers, tidy

LEAST = 100
LONGEST = 5
TOP = 2000
DROP_PER_CENT = 100
BLOCK_BYTES = 4 << 20  # text of a block; a longer single text is one block
HELD_BYTES = 16 << 20  # text of all languages that a task holds
BROADCAST_BYTES = 32 << 20
TILE = 256
DENSE_TILES = 32  # tiles of a language that a task counts directly, a quarter of a MB each
DENSE_SHARE = 48  # a tile is counted directly once a batch has TILE * TILE / DENSE_SHARE pairs in it
BATCH_PAIRS = 1 << 18  # pairs counted at once
SPARSE_CELLS = 1 << 19  # (code, count) cells of a language that a task holds; twice as many of all languages
PACKED_CELLS = 1 << 18  # cells that are made packets at once
PACKET_BYTES = 1 << 20  # of packets sent on at once
BUCKET_PAIRS = 1 << 21  # pairs of a bucket, repeated ones included; a bucket is merged in one task

BLANKS = b" \t"
STOPS = b".,;:!?\n\x0b\x0c\r"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[list(BLANKS + STOPS)] = 0
_STOP = np.zeros(256, bool)
_STOP[list(STOPS)] = True


def _words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(words, whether a piece begins with the word) of some texts."""
    low, starts, ends, rows = split_words(data, offsets, _LOWER)
    if not len(starts):
        return pa.array([], pa.large_string()), np.zeros(0, bool)
    stops = np.zeros(len(data) + 1, np.int64 if len(data) >> 31 else np.int32)
    np.cumsum(_STOP[data], out=stops[1:])
    at = stops[starts]
    begins = np.ones(len(starts), bool)
    begins[1:] = (at[1:] != at[:-1]) | (rows[1:] != rows[:-1])
    inside = np.zeros(len(low) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    text = low[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    bounds = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=bounds[1:])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(text))), begins


def _block_of(texts: list[pa.Array]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, their counts, sequence of local numbers with -1 between pieces) of a block's texts."""
    found = []
    for column in texts:
        data, offsets = text_buffers(column)
        found += [_words_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in slices(offsets)]
    found = [x for x in found if len(x[0])]
    if not found:
        return pa.array([], pa.large_string()), np.zeros(0, np.int64), np.zeros(0, np.int32)
    coded = pa.concat_arrays([words for words, _ in found]).dictionary_encode()
    broken = np.concatenate([begins for _, begins in found])
    broken[0] = False
    local = coded.indices.to_numpy().astype(np.int32)
    seq = np.full(len(local) + int(broken.sum()), -1, np.int32)
    seq[np.arange(len(local)) + np.cumsum(broken)] = local
    return coded.dictionary, np.bincount(local, minlength=len(coded.dictionary)).astype(np.int64), seq


def _block_rows(block_bytes: int):
    """(lang, text) rows to blocks of one language: block, lang, words, counts, seq."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made = TaskContext.get().partitionId(), 0
        held: dict[str, list[pa.Array]] = {}
        size: dict[str, int] = {}

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal made
            size.pop(lang)
            words, counts, seq = _block_of(held.pop(lang))
            made += 1
            one = np.array([0, len(words)], np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | made - 1]), pa.array([lang]),
                 pa.LargeListArray.from_arrays(one, words.cast(pa.string())).cast(pa.list_(pa.string())),
                 pa.LargeListArray.from_arrays(one, pa.array(counts)).cast(pa.list_(pa.int64())),
                 pa.array([seq.tobytes()], pa.binary())], names=["block", "lang", "words", "counts", "seq"])

        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            texts = batch.column(1)
            lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            codes = langs.indices.to_numpy(zero_copy_only=False)
            order = np.argsort(codes, kind="stable")
            cuts = np.searchsorted(codes[order], np.arange(len(langs.dictionary) + 1))
            for c, lang in enumerate(langs.dictionary.to_pylist()):
                mine = order[cuts[c]:cuts[c + 1]]
                filled = np.cumsum(lengths[mine]) // block_bytes
                for own in np.split(mine, np.flatnonzero(np.diff(filled)) + 1):
                    held.setdefault(lang, []).append(texts.take(pa.array(own)))
                    size[lang] = size.get(lang, 0) + int(lengths[own].sum())
                    if size[lang] >= block_bytes:
                        yield flush(lang)
                        release_memory()
            while sum(size.values()) > HELD_BYTES:
                yield flush(max(size, key=size.get))
        for lang in list(size):
            yield flush(lang)
    return run


def _sequences(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.int32) for x in column.to_pylist()]


def _squeezed(seq: np.ndarray) -> np.ndarray:
    """Without numbers that have no neighbour, and with one -1 for each run of them."""
    good = seq >= 0
    side = np.zeros(len(seq), bool)
    side[1:] |= good[:-1]
    side[:-1] |= good[1:]
    seq = np.where(good & side, seq, -1).astype(np.int32)
    keep = seq >= 0
    keep[1:] |= seq[:-1] >= 0
    return seq[keep]


def _pairs(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, codes) of neighbours; a code is the first rank in the upper and the second in the lower 32 bits."""
    at = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0)) if len(seq) > 1 else np.zeros(0, np.int64)
    return at, seq[at].astype(np.int64) << 32 | seq[at + 1].astype(np.int64)


def _summed(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, sorted, with their counts."""
    if counts is None:
        codes = np.sort(codes)
        first = np.flatnonzero(np.diff(codes, prepend=-1))
        return codes[first], np.diff(np.append(first, len(codes)))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[first], np.add.reduceat(counts, first) if len(first) else counts


class TileCounter:
    """Counts of pair codes: well-filled tiles in dense arrays, the others as sorted lists of cells."""

    def __init__(self, tile: int = TILE, dense_tiles: int = DENSE_TILES):
        self.tile, self.dense_tiles = tile, dense_tiles
        self.dense: dict[int, np.ndarray] = {}
        self.sparse: list[tuple[np.ndarray, np.ndarray]] = []
        self.cells = self.pairs = 0

    def add(self, codes: np.ndarray) -> None:
        if not len(codes):
            return
        self.pairs += len(codes)
        t = self.tile
        x, y = codes >> 32, codes & 0xFFFFFFFF
        tiles, inverse, filled = np.unique((x // t) << 32 | y // t, return_inverse=True, return_counts=True)
        direct = np.array([int(k) in self.dense for k in tiles])
        for k in np.argsort(-filled):
            if filled[k] * DENSE_SHARE < t * t or len(self.dense) >= self.dense_tiles:
                break
            if not direct[k]:
                self.dense[int(tiles[k])] = np.zeros(t * t, np.int32)
                direct[k] = True
        chosen = direct[inverse]
        if chosen.any():
            cell = (x % t * t + y % t)[chosen]
            of = inverse[chosen]
            order = np.argsort(of, kind="stable")
            of, cell = of[order], cell[order]
            for part in np.split(np.arange(len(of)), np.flatnonzero(np.diff(of)) + 1):
                self.dense[int(tiles[of[part[0]]])] += np.bincount(cell[part], minlength=t * t).astype(np.int32)
        rest = codes[~chosen]
        if len(rest):
            self.sparse.append(_summed(rest))
            self.cells += len(self.sparse[-1][0])
            if self.cells > SPARSE_CELLS:
                self._merge()

    def _merge(self) -> None:
        self.sparse = [_summed(*(np.concatenate(x) for x in zip(*self.sparse)))]
        self.cells = len(self.sparse[0][0])

    def full(self) -> bool:
        """Whether it is to be emptied: half the cells are distinct, or a cell of a tile might overflow."""
        return self.cells > SPARSE_CELLS // 2 and len(self.sparse) == 1 or self.pairs >> 30 > 0

    def take(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All (codes, counts) so far; the counter is empty then."""
        if self.sparse:
            self._merge()
            yield self.sparse[0]
        t = self.tile
        for k, cells in self.dense.items():
            at = np.flatnonzero(cells)
            yield ((k >> 32) * t + at // t) << 32 | ((k & 0xFFFFFFFF) * t + at % t), cells[at].astype(np.int64)
        self.dense, self.sparse, self.cells, self.pairs = {}, [], 0, 0


def _planes(values: np.ndarray) -> tuple[int, bytes]:
    """(width, bytes) of non-negative numbers: their lowest bytes, then the next ones, as many as the largest needs."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return width, values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _packed(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """A packet of cells in the order of their codes: the widths, the codes' differences and the counts."""
    (a, near), (b, many) = _planes(np.diff(codes, prepend=0)), _planes(counts)
    return bytes((a, b)) + near + many


def _unpacked(packet) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(packet, np.uint8)
    a, b = int(raw[0]), int(raw[1])
    n = (len(raw) - 2) // (a + b)
    wide = np.zeros((2, n, 8), np.uint8)
    wide[0, :, :a] = raw[2:2 + n * a].reshape(a, n).T
    wide[1, :, :b] = raw[2 + n * a:].reshape(b, n).T
    near, counts = wide.view("<i8")[..., 0]
    return np.cumsum(near), counts


def _packets(pieces: Iterator[tuple[np.ndarray, np.ndarray]], buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, packet) of cells; some pieces together, as the cells of a tile are few."""
    held, size = [], 0

    def send() -> Iterator[tuple[int, bytes]]:
        codes, counts = _summed(*(np.concatenate(x) for x in zip(*held)))
        held.clear()
        own = (mix64(codes.astype(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(own, kind="stable")
        codes, counts, own = codes[order], counts[order], own[order]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        for i, j in zip(first.tolist(), [*first[1:].tolist(), len(own)]):
            yield int(own[i]), _packed(codes[i:j], counts[i:j])

    for codes, counts in pieces:
        for a in range(0, len(codes), PACKED_CELLS):
            held.append((codes[a:a + PACKED_CELLS], counts[a:a + PACKED_CELLS]))
            size += len(held[-1][0])
            if size >= PACKED_CELLS:
                yield from send()
                size = 0
    if held:
        yield from send()


def _count_pairs(tile: int, buckets: int):
    """(lang, seq) rows to packets of counted pairs: lang, bucket, cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, TileCounter] = {}

        def row_batch(lang: str, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(rows), pa.string()), pa.array([k for k, _ in rows], pa.int32()),
                 pa.array([x for _, x in rows], pa.binary())], names=["lang", "bucket", "cells"])

        def send(lang: str) -> Iterator[pa.RecordBatch]:
            rows, size = [], 0
            for bucket, packet in _packets(counters.pop(lang).take(), buckets):
                rows.append((bucket, packet))
                size += len(packet)
                if size >= PACKET_BYTES:
                    yield row_batch(lang, rows)
                    rows, size = [], 0
            if rows:
                yield row_batch(lang, rows)
            release_memory()

        for batch in batches:
            for lang, seq in zip(batch.column(0).to_pylist(), _sequences(batch.column(1))):
                for a in range(0, len(seq), BATCH_PAIRS):
                    if lang not in counters:  # the dense tiles of all languages together are bounded
                        while sum(c.dense_tiles for c in counters.values()) > 3 * DENSE_TILES:
                            yield from send(next(iter(counters)))
                        counters[lang] = TileCounter(tile)
                    counters[lang].add(_pairs(seq[a:a + BATCH_PAIRS + 1])[1])  # the last number has its neighbour in the next part
                    if counters[lang].full():
                        yield from send(lang)
                    while sum(c.cells for c in counters.values()) > 2 * SPARSE_CELLS:
                        yield from send(max(counters, key=lambda x: counters[x].cells))
        for lang in list(counters):
            yield from send(lang)
    return run


def _merge_packets(least: int):
    """Packets, those of one language and bucket together, to rows (lang, code, f) with f >= least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, size, most = None, [], 0, PACKED_CELLS

        def merge() -> tuple[np.ndarray, np.ndarray]:
            return _summed(*(np.concatenate(x) for x in zip(*held)))

        def send() -> Iterator[pa.RecordBatch]:
            codes, counts = merge()
            often = counts >= least
            codes, counts = codes[often], counts[often]
            for a in range(0, len(codes), 1 << 16):
                own = codes[a:a + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.DictionaryArray.from_arrays(np.zeros(len(own), np.int32), [key[0]]).cast(pa.string()),
                     pa.array(own), pa.array(counts[a:a + (1 << 16)])], names=["lang", "code", "f"])

        for batch in batches:
            for lang, bucket, cells in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (lang, bucket) != key:
                    if held:
                        yield from send()
                    key, held, size, most = (lang, bucket), [], 0, PACKED_CELLS
                held.append(_unpacked(cells.as_buffer()))
                size += len(held[-1][0])
                if size > most:  # at least half of them are new since the last time
                    held = [merge()]
                    size = len(held[0][0])
                    most = max(PACKED_CELLS, 2 * size)
        if held:
            yield from send()
    return run


def _frequent_pairs(level: DataFrame, least: int, tile: int, words: int) -> DataFrame:
    """(lang, code, f) of the pairs of neighbours that occur ``least`` times; ``words``: at least as many as there are places."""
    parts = int(level.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = parts * max(1, -(-words // (parts * BUCKET_PAIRS)))
    return (level.select("lang", "seq").mapInArrow(tidy(_count_pairs(tile, buckets)), "lang string, bucket int, cells binary")
            .repartitionById(parts, F.col("bucket") % parts).sortWithinPartitions("lang", "bucket")
            .mapInArrow(tidy(_merge_packets(least)), "lang string, code long, f long"))


def _ranked(counts: DataFrame, key: str, name: str) -> DataFrame:
    """Stored (lang, key, f, rank): numbers from 0 in falling order of f, by language; no task sees a whole language."""
    spark = counts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = stored(counts, f"{name}-counts")  # range partitioning reads it twice
    dealt = (counts.repartitionByRange(parts, "lang", F.desc("f"), key).sortWithinPartitions("lang", F.desc("f"), key)
             .withColumn("row", F.monotonically_increasing_id()).withColumn("part", F.shiftright("row", 33)))
    dealt = stored(dealt, f"{name}-sorted")
    size = dealt.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    start = size.select("lang", "part", "first", F.coalesce(before, F.lit(0)).alias("before"))
    return stored(dealt.join(start, ["lang", "part"])
                  .select("lang", key, "f", (F.col("row") - F.col("first") + F.col("before")).cast("int").alias("rank")), name)


def _look_up_words(table: dict[str, tuple[pa.Array, np.ndarray]]):
    """Local numbers to ranks by a broadcast dictionary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, (lang, seq) in enumerate(zip(batch.column(1).to_pylist(), _sequences(batch.column(3)))):
                words = batch.column(2).slice(k, 1).flatten()
                ranks = np.full(len(words) + 1, -1, np.int32)  # the last is for -1
                if lang in table.value:
                    known, rank = table.value[lang]
                    found = pc.index_in(words, value_set=known)
                    ok = found.is_valid().to_numpy(zero_copy_only=False)
                    ranks[:-1][ok] = rank[found.drop_null().to_numpy()]
                yield _sequence_row(batch.column(0)[k], lang, ranks[seq])
    return run


def _look_up_pairs(table):
    """Neighbouring ranks to the rank of their pair by a broadcast dictionary of sorted codes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lang, seq in zip(batch.column(0), batch.column(1).to_pylist(), _sequences(batch.column(2))):
                codes, ranks = table.value.get(lang, (np.zeros(0, np.int64), np.zeros(0, np.int32)))
                yield _sequence_row(block, lang, _paired(seq, codes, ranks))
    return run


def _paired(seq: np.ndarray, codes: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    out = np.full(len(seq), -1, np.int32)
    at, own = _pairs(seq)
    if len(codes) and len(own):
        place = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        out[at] = np.where(codes[place] == own, ranks[place], -1)
    return out


def _sequence_row(block, lang: str, seq: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([block.as_py()]), pa.array([lang]), pa.array([_squeezed(seq).tobytes()], pa.binary())],
                                      names=["block", "lang", "seq"])


SEQ = "block long, lang string, seq binary"


def _distinct_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block, lang, seq in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _sequences(batch.column(2))):
            codes = _summed(_pairs(seq)[1])[0]
            for a in range(0, len(codes), 1 << 16):
                own = codes[a:a + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block)), pa.array([lang] * len(own)), pa.array(own)],
                                                 names=["block", "lang", "code"])


def _joined_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, lang, seq, known) with the block's (local number, rank) list."""
    for batch in batches:
        for k, (lang, seq) in enumerate(zip(batch.column(1).to_pylist(), _sequences(batch.column(2)))):
            pairs = batch.column(3).slice(k, 1).flatten()
            local, rank = (pairs.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            ranks = np.full(max(seq.max(initial=-1), local.max(initial=-1)) + 2, -1, np.int32)
            ranks[local] = rank
            yield _sequence_row(batch.column(0)[k], lang, ranks[seq])


def _joined_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, lang, seq, known) with the block's (code, rank) list."""
    for batch in batches:
        for k, (lang, seq) in enumerate(zip(batch.column(1).to_pylist(), _sequences(batch.column(2)))):
            pairs = batch.column(3).slice(k, 1).flatten()
            codes, ranks = (pairs.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            order = np.argsort(codes)
            yield _sequence_row(batch.column(0)[k], lang, _paired(seq, codes[order], ranks[order]))


def _by_language(ranked: DataFrame, key: str, sort: bool) -> dict:
    """A dictionary whose size is known to be bounded, as arrays by language."""
    rows = ranked.select("lang", key, "rank").toArrow()
    out = {}
    for lang in pc.unique(rows["lang"]).to_pylist():
        own = rows.filter(pc.equal(rows["lang"], lang))
        if sort:
            own = own.sort_by(key)
        keys, ranks = own[key].combine_chunks(), own["rank"].to_numpy().astype(np.int32)
        out[lang] = (keys.to_numpy() if sort else keys, ranks)
    return out


def _to_ranks(blocks: DataFrame, ranked: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Level 1: blocks of local numbers to sequences of ranks."""
    size = ranked.agg(F.sum(F.octet_length("word") + 16)).first()[0] or 0
    if size <= broadcast_bytes:
        table = blocks.sparkSession.sparkContext.broadcast(_by_language(ranked, "word", sort=False))
        return blocks.select("block", "lang", "words", "seq").mapInArrow(tidy(_look_up_words(table)), SEQ)
    own = blocks.select("block", "lang", F.posexplode("words").alias("local", "word"))
    known = (own.join(ranked.select("lang", "word", "rank"), ["lang", "word"]).groupBy("block")
             .agg(F.collect_list(F.struct("local", "rank")).alias("known")))  # at most a block's distinct words
    return blocks.select("block", "lang", "seq").join(known, "block").mapInArrow(tidy(_joined_words), SEQ)


def _to_pair_ranks(level: DataFrame, ranked: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Sequences of ranks to sequences of ranks of pairs."""
    if ranked.count() * 12 <= broadcast_bytes:
        table = level.sparkSession.sparkContext.broadcast(_by_language(ranked, "code", sort=True))
        return level.mapInArrow(tidy(_look_up_pairs(table)), SEQ)
    known = (level.mapInArrow(tidy(_distinct_pairs), "block long, lang string, code long")
             .join(ranked.select("lang", "code", "rank"), ["lang", "code"]).groupBy("block")
             .agg(F.collect_list(F.struct("code", "rank")).alias("known")))  # at most a block's distinct pairs
    return level.join(known, "block").select("block", "lang", "seq", "known").mapInArrow(tidy(_joined_pairs), SEQ)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text_col: str = "text", lang_col: str = "lang",
                     block_bytes: int = BLOCK_BYTES, broadcast_bytes: int = BROADCAST_BYTES,
                     tile: int = TILE) -> tuple[DataFrame, DataFrame]:
    """Stored (lang, m, phrase, f) of all phrases of 1 to ``longest`` words with f >= ``least``, and (lang, n) of all words."""
    rows = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    blocks = stored(rows.mapInArrow(tidy(_block_rows(block_bytes)), "block long, lang string, words array<string>, counts array<long>, seq binary"),
                    "phrase-blocks")
    total = stored(blocks.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")),
                   "phrase-words")
    all_words = total.agg(F.sum("n")).first()[0] or 0
    words = (blocks.select("lang", F.inline(F.arrays_zip("words", "counts")))
             .groupBy("lang", F.col("words").alias("word")).agg(F.sum("counts").alias("f")).where(F.col("f") >= least))
    ranked = _ranked(words, "word", "phrase-1")
    phrases = ranked.select("lang", F.lit(1).alias("m"), F.col("word").alias("phrase"), "f", "rank")
    out = phrases.drop("rank")
    level = stored(_to_ranks(blocks, ranked, broadcast_bytes), "phrase-seq-1")
    for m in range(2, longest + 1):
        ranked = _ranked(_frequent_pairs(level, least, tile, all_words), "code", f"phrase-pairs-{m}")
        first = phrases.select("lang", F.col("rank").alias("x"), F.col("phrase").alias("head"))
        second = phrases.select("lang", F.col("rank").alias("y"), F.substring_index("phrase", " ", -1).alias("tail"))
        coded = ranked.select("*", F.shiftright("code", 32).cast("int").alias("x"),
                              F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("y"))
        phrases = stored(coded.join(first, ["lang", "x"]).join(second, ["lang", "y"])
                         .select("lang", F.lit(m).alias("m"), F.concat_ws(" ", "head", "tail").alias("phrase"), "f", "rank"), f"phrase-{m}")
        out = out.unionByName(phrases.drop("rank"))
        if m < longest:
            level = stored(_to_pair_ranks(level, ranked, broadcast_bytes), f"phrase-seq-{m}")
    return out, total


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, drop_per_cent: int = DROP_PER_CENT,
         **options) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score."""
    known, total = frequent_phrases(docs, least, longest, **options)
    found = known.where("m > 1").select("lang", "m", "phrase", F.col("f").alias("a"), F.split("phrase", " ", -1).alias("w"))

    def words(begin, size):
        return F.array_join(F.slice("w", begin, size), " ")

    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", words(F.lit(1), F.col("k")).alias("x"),
                       words(F.col("k") + 1, F.col("m") - F.col("k")).alias("y"))
    left = known.select("lang", F.col("phrase").alias("x"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("y"), F.col("f").alias("r"))
    score = F.expr("CAST((CAST(1000 AS DECIMAL(4,0)) * CAST(a AS DECIMAL(17,0)) * CAST(n AS DECIMAL(17,0))) "
                   "div (CAST(l AS DECIMAL(17,0)) * CAST(r AS DECIMAL(17,0))) AS BIGINT)")
    scored = (cuts.join(left, ["lang", "x"]).join(right, ["lang", "y"]).join(total, "lang").withColumn("score", score)
              .groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("s")).select("lang", "phrase", "s.*"))

    inner = found.where("m > 2").withColumn("z", F.explode(F.sequence(F.lit(2), F.col("m") - 1)))
    inner = inner.withColumn("b", F.explode(F.sequence(F.lit(1), F.col("m") - F.col("z") + 1)))
    inner = (inner.select("lang", words(F.col("b"), F.col("z")).alias("phrase"), F.col("a").alias("longer"))
             .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = (scored.join(inner, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull() | (100 * F.col("longer") < drop_per_cent * F.col("a"))))
    by = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
