"""Token-id files: an adaptive context-mixing range coder over independently reset, checksummed blocks.

Ids (below 2**16) are numbered by falling count in their frame.  An id is coded in one step: either it is the one its contexts
expect (order 2, the two previous ids, if known in the block, else order 1), or it takes its share of the rest of the interval by
the counts of the frame (order 0).  The chance of a hit is mixed in the logistic domain from the order-0 share of the expected
id and the hit rates at the trust in the order-1 and order-2 slots; trust, rates and weights learn from every id.  Order-1
slots begin with the commonest successor in the frame; order-2 slots have check bits.  All arithmetic is on integers (one exact
division of floats apart), so every machine decodes alike.  A block holds ``BLOCK`` ids, starts with a fresh model and has a
CRC-32 of its ids.  Blocks do not depend on each other, so many are coded side by side, one numpy lane each.

A file is a row of frames; a frame holds whole documents: magic, sizes, document ids and lengths, block sizes
checksums and id counts, then the blocks.  Documents are range-partitioned by id and sorted, so files follow each
other in ascending id order; a table of files gives each its first position.  Files carry the task attempt in their name
and only those of attempts that succeed are in that table.

Defined cases: null text is empty and still has its end id; a null document id sorts first and is read back as
null; documents that repeat an id all stay, next to each other; damage raises.
"""

from __future__ import annotations

import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from .bpe import WordCoder, text_slices
from .common import shared_path, stored, tidy
from .warc import DamagedArchive, _storage

BLOCK = 2048  # ids
LANES = 4096  # blocks coded side by side
FRAME = BLOCK * LANES  # ids after which a frame ends with its document
FILE_BYTES = 64 << 20
MOST_READERS = 10_000
CHARS = 8 << 20  # coded at once
WORDS = 2048  # given to the library in one text
ROOM = 6  # size of the cache of chunks, in those of ``bpe``
MAGIC = b"IDS3"
_HEAD = struct.Struct("<4sIIQII")  # magic, documents, blocks, ids, bytes of the id counts, checksum of the tables
SLOTS = 1 << 12  # contexts of one order
PAIRS = 1024  # the most frequent ids, whose successors are counted
_WHOLE, _SHARES = 24, 16  # bits of a step's interval and of the shares of ids
_STRETCH = np.array([max(-2047, min(2047, round(256 * math.log((p + 0.5) / (4095.5 - p))))) for p in range(4096)], np.int64)
_SQUASH = np.array([round(4096 / (1 + math.exp(-x / 256))) for x in range(-2047, 2048)], np.int64).clip(1, 4080)
_TRUST = np.array([0, 1, 0, 2, 1, 3, 1, 4, 2, 5, 2, 6, 3, 7, 3, 7])  # of an expected id, after a miss and a hit at each trust
_TRUST_2 = np.maximum(_TRUST, 1)  # of order 2: a context once seen keeps an id
_CHECK = 0xFFF << 19
_FIRST = np.array([0.02, 0.1, 0.3, 0.5, 0.6, 0.7, 0.8, 0.9]) * 65536  # chance of a hit by trust
_WEIGHTS = np.array([[4000], [33000], [30000]])


class Tree:
    """What the blocks of a frame share: its ids by falling count, their shares of an interval (of 2**16, at least one each), and
    of the most frequent ids the commonest successor with the trust in it.

    ``find`` leads from a place in the interval to the number of an id, ``number`` from an id to it."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray, follow: np.ndarray | None = None, trust: np.ndarray | None = None):
        order = np.argsort(-counts.astype(np.int64), kind="stable")
        self.ids, self.counts, n = ids.astype(np.int64)[order], counts.astype(np.int64)[order], len(ids)
        share = 1 + self.counts * ((1 << _SHARES) - n) // max(1, int(self.counts.sum()))
        share[:1] += (1 << _SHARES) - share.sum()
        self.ends = np.append(0, np.cumsum(share))
        self.find = np.repeat(np.arange(n), share)
        self.prior = _STRETCH.take(share >> _SHARES - 12, mode="clip")
        self.number = np.zeros(1 << 16, np.int32)
        self.number[self.ids] = np.arange(n)
        side = min(n, PAIRS)
        self.follow = np.zeros(side, np.int64) if follow is None else follow.astype(np.int64)
        self.trust = np.zeros(side, np.int64) if trust is None else trust.astype(np.int64)

    @staticmethod
    def of(ids: np.ndarray) -> "Tree":
        counts = np.bincount(ids)
        own = np.flatnonzero(counts)
        tree = Tree(own, counts[own])
        side = len(tree.follow)
        if side:
            numbers = np.minimum(tree.number, np.int32(side)).take(ids)  # ``side``: any rarer id
            pairs = np.bincount(numbers[:-1] * (side + 1) + numbers[1:], minlength=(side + 1) ** 2).reshape(side + 1, side + 1)[:side, :side]
            tree.follow, most = pairs.argmax(axis=1), pairs.max(axis=1)
            tree.trust = np.where(most < 4, 0, 1 + np.searchsorted(_FIRST[2:], most * 65536 // tree.counts[:side]))
            tree.follow[most < 4] = 0
        return tree

    def table(self) -> bytes:
        order, side = np.argsort(self.ids), len(self.follow)
        parts = (np.diff(self.ids[order], prepend=0).astype("<u2"), self.counts[order].astype("<u4"), self.follow.astype("<u2"), self.trust.astype("u1"))
        planes = [x.view("u1").reshape(len(x), x.itemsize).T.tobytes() for x in parts]
        return struct.pack("<II", len(self.ids), side) + zlib.compress(b"".join(planes), 9)

    @staticmethod
    def read(data: bytes) -> "Tree":
        (n, side), raw, parts = struct.unpack("<II", data[:8]), zlib.decompress(data[8:]), []
        for size, kind in ((n, "<u2"), (n, "<u4"), (side, "<u2"), (side, "u1")):
            width = np.dtype(kind).itemsize
            parts.append(np.frombuffer(raw[:size * width], "u1").reshape(width, size).T.copy().view(kind).ravel())
            raw = raw[size * width:]
        return Tree(np.cumsum(parts[0].astype(np.int64)), *parts[1:])


class _Model:
    """The models of ``n`` lanes.  ``expect`` gives each lane's expected id and the chance (of 2**24) that it comes, ``learn``
    updates.  A slot is an expected id and the trust in it (3 bits), of order 2 below 12 check bits; the lanes' slots of a context
    lie side by side, as most of them are often in the same few contexts."""

    def __init__(self, n: int, tree: Tree):
        lane = np.arange(n)
        self.tree, self.n = tree, n
        first = np.zeros(SLOTS, np.int32)
        first[:len(tree.follow)] = tree.follow << 3 | tree.trust
        self.one, self.two = np.repeat(first, n), np.zeros(n * SLOTS, np.int32)
        self.lane, self.lane1, self.lane2 = lane, lane * 16, lane * 8
        self.chance1 = np.tile(np.concatenate([_FIRST / 2, _FIRST]).astype(np.int64), n)
        self.chance2 = np.tile(_FIRST.astype(np.int64), n)
        self.weights = np.repeat(_WEIGHTS, n, axis=1)
        self.last, self.hash, self.before = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.said = np.empty((3, n), np.int64)

    def expect(self) -> tuple[np.ndarray, np.ndarray]:
        self.at1 = (self.last & SLOTS - 1) * self.n + self.lane
        self.at2 = (self.hash >> 7 & SLOTS - 1) * self.n + self.lane
        one, two = self.one.take(self.at1).astype(np.int64), self.two.take(self.at2).astype(np.int64)
        self.c1, self.t1 = one >> 3, one & 7
        self.check = self.hash & _CHECK
        self.t2 = (two & 7) * (two & _CHECK == self.check)
        self.c2 = two >> 3 & 0xFFFF
        likely = self.c1.copy()
        np.copyto(likely, self.c2, where=self.t2 > 0)
        self.i1 = ((likely == self.c1) * 8) + self.t1 + self.lane1
        self.i2 = self.t2 + self.lane2
        self.q1, self.q2, said = self.chance1.take(self.i1), self.chance2.take(self.i2), self.said
        self.tree.prior.take(likely, out=said[0], mode="clip")
        _STRETCH.take(self.q1 >> 4, out=said[1], mode="clip")
        _STRETCH.take(self.q2 >> 4, out=said[2], mode="clip")
        sums = self.weights * said
        self.p = _SQUASH.take((sums[0] + sums[1] + sums[2] >> 16) + 2047, mode="clip")
        return likely, self.p << _WHOLE - 12

    def learn(self, ids: np.ndarray, hit: np.ndarray):
        """Update with the numbers of the ids that came, and where the expected ones did."""
        y = hit * 65535
        self.chance1[self.i1] = self.q1 + (y - self.q1 >> 5)
        self.chance2[self.i2] = self.q2 + (y - self.q2 >> 5)
        self.weights += self.said * ((y >> 3) - self.p * 2) >> 14
        for table, at, id_, trust, same, after, check in (
                (self.one, self.at1, self.c1, self.t1, ids == self.c1, _TRUST, None),
                (self.two, self.at2, self.c2, self.t2, ids == self.c2, _TRUST_2, self.check)):
            new = ids.copy()
            np.copyto(new, id_, where=trust > 1)
            value = (new << 3) + after.take(trust * 2 + same, mode="clip")
            if check is not None:
                value |= check
            table[at] = value.astype(np.int32)
        self.hash = ids * 0x2F0B4C47 + self.before
        self.before = ids * 0x1C6EF372
        self.last = ids


def _lanes(total: int) -> tuple[int, int, int]:
    """Ids of a block, blocks, and the ids of the last one."""
    block = min(BLOCK, total)
    n = -(-total // block)
    return block, n, total - (n - 1) * block


def encode_blocks(ids: np.ndarray, tree: Tree) -> list[bytes]:
    """The coded blocks of a run of ids.  The models go on from id to id, all blocks at once, and give each id's part of the interval;
    the range coder (asymmetric numeral systems, 32 bits a word) then takes these from the last to the first."""
    if not len(ids):
        return []
    block, n, tail = _lanes(len(ids))
    grid = np.zeros(n * block, np.int32)
    grid[:len(ids)] = tree.number.take(ids)
    grid = grid.reshape(n, block).T.astype(np.int64, order="C")
    model, begin, size = _Model(n, tree), np.empty((block, n), np.int32), np.empty((block, n), np.int32)
    for t in range(block):
        own = grid[t]
        likely, chance = model.expect()
        hit = own == likely
        rest = (1 << _WHOLE) - chance
        low = tree.ends.take(own) * rest >> _SHARES
        high = tree.ends.take(own + 1) * rest >> _SHARES
        begin[t] = (low + chance) * ~hit
        high -= low
        np.copyto(high, chance, where=hit)
        size[t] = high
        model.learn(own, hit)
    del model, grid
    x, out, full = np.full(n, 1 << 31, np.int64), np.empty((block, n), np.uint32), np.empty((block, n), bool)
    full[tail:, n - 1] = False
    for t in range(block - 1, -1, -1):
        m = n if t < tail else n - 1
        own, f = x[:m], size[t, :m].astype(np.int64)
        over = np.greater_equal(own, f << 39, out=full[t, :m])
        out[t, :m] = own & 0xFFFFFFFF
        own = own >> over * 32
        q = own // f
        x[:m] = (q << _WHOLE) + (own - q * f) + begin[t, :m]
    del begin, size
    words, many = np.ascontiguousarray(out.T)[full.T].astype("<u4"), np.append(0, np.cumsum(full.sum(axis=0)))
    heads = x.astype("<i8")
    return [heads[j].tobytes() + words[many[j]:many[j + 1]].tobytes() for j in range(n)]


def decode_blocks(coded: list[bytes], total: int, tree: Tree) -> np.ndarray:
    """The ``total`` ids of a run of blocks."""
    if not coded:
        return np.zeros(0, np.int64)
    block, n, tail = _lanes(total)
    if not len(tree.ids) or n != len(coded) or any(len(b) < 8 or len(b) % 4 for b in coded):
        raise DamagedArchive("blocks of a frame")
    data = np.frombuffer(b"".join(coded) + bytes(4), "<u4").astype(np.int64)
    ends = np.cumsum([len(b) // 4 for b in coded])
    at = np.append(0, ends[:-1])
    x, at = data[at] | (data[at + 1] & 0x7FFFFFFF) << 32, at + 2
    model, grid = _Model(n, tree), np.empty((block, n), np.int32)
    for t in range(block):
        likely, chance = model.expect()
        place = x & (1 << _WHOLE) - 1
        hit = place < chance
        rest = (1 << _WHOLE) - chance
        own = tree.find.take((((place - chance + 1 << _SHARES) - 1) / rest).astype(np.int64), mode="clip")  # exact: below 2**53
        low = tree.ends.take(own) * rest >> _SHARES
        f = (tree.ends.take(own + 1) * rest >> _SHARES) - low
        low += chance
        low *= ~hit
        np.copyto(f, chance, where=hit)
        np.copyto(own, likely, where=hit)
        x = f * (x >> _WHOLE) + place - low
        short = x < 1 << 31
        x = np.where(short, x << 32 | data.take(at, mode="clip"), x)
        at += short
        grid[t] = own
        model.learn(own, hit)
    del model, data
    return tree.ids.astype(np.int32).take(grid.T.ravel()[:total], mode="clip")


def frame(doc_ids: list, counts: list[int], ids: np.ndarray) -> bytes:
    if len(ids) and (ids.min() < 0 or ids.max() >= 1 << 16):
        raise ValueError("ids must lie below 2**16")
    blocks, tree = [], Tree.of(ids)
    for k in range(0, len(ids), BLOCK * LANES):
        blocks += encode_blocks(ids[k:k + BLOCK * LANES], tree)
    shape = tree.table()
    sums = [zlib.crc32(ids[k:k + BLOCK].astype("<u4").tobytes()) for k in range(0, len(ids), BLOCK)]
    tables = (np.array([d is None for d in doc_ids], np.uint8).tobytes() + np.array([d or 0 for d in doc_ids], "<i8").tobytes()
              + np.array(counts, "<u8").tobytes() + np.array([len(b) for b in blocks], "<u4").tobytes() + np.array(sums, "<u4").tobytes()
              + shape)
    return _HEAD.pack(MAGIC, len(doc_ids), len(blocks), len(ids), len(shape), zlib.crc32(tables)) + tables + b"".join(blocks)


def read_frames(source) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(document ids, lengths, ids) of each frame of an open file, checked."""
    def take(n: int) -> bytes:
        data = source.read(n)
        if len(data) != n:
            raise DamagedArchive("the file ends within a frame")
        return data

    while head := source.read(_HEAD.size):
        if len(head) != _HEAD.size or head[:4] != MAGIC:
            raise DamagedArchive("not a frame")
        _, docs, blocks, total, shape, check = _HEAD.unpack(head)
        tables = take(docs * 17 + blocks * 8 + shape)
        if zlib.crc32(tables) != check:
            raise DamagedArchive("tables of a frame")
        tree = Tree.read(tables[len(tables) - shape:])
        none, own = np.frombuffer(tables, np.uint8, docs), np.frombuffer(tables, "<i8", docs, docs)
        counts = np.frombuffer(tables, "<u8", docs, docs * 9).astype(np.int64)
        lens, sums = (np.frombuffer(tables, "<u4", blocks, docs * 17 + k * blocks * 4) for k in (0, 1))
        ids = []
        for k in range(0, blocks, LANES):
            some = [take(int(x)) for x in lens[k:k + LANES]]
            ids.append(decode_blocks(some, min(total - k * BLOCK, len(some) * BLOCK), tree))
        ids = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        for k in range(blocks):
            if zlib.crc32(ids[k * BLOCK:(k + 1) * BLOCK].astype("<u4").tobytes()) != sums[k]:
                raise DamagedArchive("checksum of a block")
        yield [None if x else int(d) for x, d in zip(none, own)], counts, ids


_CODERS: dict[str, WordCoder] = {}


def library_coder(path: str) -> WordCoder:
    """Encodes with the tokenizers library, each word once.  Words come normalised and split, so they go to the library many in a text,
    parted by blanks; the ids of a word end with one that has the vocabulary's mark."""
    if path not in _CODERS:
        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        special = {x.content: k for k, x in t.get_added_tokens_decoder().items()}
        mark = t.model.end_of_word_suffix
        last = np.zeros(max(t.get_vocab().values()) + 1, bool)
        last[[k for x, k in t.get_vocab().items() if mark and x.endswith(mark)]] = True
        plain = Tokenizer(t.model)
        plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "),
                                                       pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

        def words(new: list[str]):
            ids, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for k in range(0, len(new), WORDS):
                some = new[k:k + WORDS]
                found = np.array(plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, np.int64)
                n = np.diff(np.flatnonzero(last[found]), prepend=-1)
                if len(n) != len(some) or n.sum() != len(found):  # no mark, or a byte that the vocabulary lacks
                    each = [e.ids for e in t.encode_batch_fast(some, add_special_tokens=False)]
                    found, n = np.array([i for x in each for i in x], np.int64), np.fromiter(map(len, each), np.int64, len(each))
                ids.append(found)
                counts.append(n)
            return np.concatenate(ids), np.concatenate(counts)
        _CODERS[path] = WordCoder(special, words, ROOM)
    return _CODERS[path]


def _writer(path: str, folder: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, context = library_coder(path), TaskContext.get()
        fs, place = _storage(folder)
        name = f"{context.partitionId():06d}-{context.taskAttemptId()}"
        out, seq, size, written, done = None, 0, 0, 0, []
        docs, counts, held, waiting = [], [], [], 0

        def put():
            nonlocal out, seq, size, written, waiting
            if out is None:
                seq += 1
                out = fs.open_output_stream(f"{place}/{name}-{seq:04d}.ids", compression=None)
            ids = np.concatenate(held)
            held.clear()
            data = frame(docs, counts, ids)
            out.write(data)
            size, written, waiting = size + len(data), written + len(ids), 0
            docs.clear(), counts.clear()

        def close():
            nonlocal out, size, written
            out.close()
            done.append((f"{folder}/{name}-{seq:04d}.ids", context.partitionId(), seq, size, written))
            out, size, written = None, 0, 0

        def code():
            nonlocal waiting
            ids, offsets = coder.encode(texts)
            for d, i, j in zip(keys, offsets[:-1], offsets[1:]):
                docs.append(d)
                counts.append(int(j - i) + 1)
                held.extend((ids[i:j], np.array([end_id], ids.dtype)))
                waiting += counts[-1]
                if waiting >= FRAME:
                    put()
                    if size >= FILE_BYTES:
                        close()
            keys.clear(), texts.clear()

        keys, texts, chars = [], [], 0
        for b in batches:
            for part, some in text_slices(b, 1):
                keys += part.column(0).to_pylist()
                texts += some
                chars += sum(map(len, some))
                if chars >= CHARS:
                    code()
                    chars = 0
        if texts:
            code()
        if docs:
            put()
        if out is not None:
            close()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), (pa.string(), *[pa.int64()] * 4))],
                                             names=["file", "part", "seq", "bytes", "ids"])
    return run


def write_files(docs: DataFrame, path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text",
                folder: str | None = None) -> DataFrame:
    """Write the files; returns their table (file, bytes, ids, start), itself in the shared folder."""
    folder = folder or shared_path(docs.sparkSession, "ids")
    fs, place = _storage(folder)
    fs.create_dir(place, recursive=True)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange(F.col("id").asc_nulls_first(), F.xxhash64("text"))
    rows = rows.sortWithinPartitions(F.col("id").asc_nulls_first(), F.xxhash64("text"))
    files = stored(rows.mapInArrow(tidy(_writer(path, folder, end_id)), "file string, part long, seq long, bytes long, ids long"), "files")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return files.select("file", "bytes", "ids", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("start"))


def _reader(keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                fs, path = _storage(file)
                with fs.open_input_stream(path, compression=None) as source:
                    for docs, counts, ids in read_frames(source):
                        ends = np.append(0, np.cumsum(counts))
                        sums = [zlib.crc32(ids[i:j].astype("<u4").tobytes()) for i, j in zip(ends[:-1], ends[1:])]
                        lists = (pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())) if keep_ids
                                 else pa.nulls(len(docs), pa.list_(pa.int32())))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(docs, pa.int64()), pa.array(start + ends[:-1]), pa.array(counts), pa.array(sums, pa.int64()), lists],
                            names=["id", "start", "n_tokens", "ids_crc32", "ids"])
                        start += int(ends[-1])
    return run


def read_files(files: DataFrame, keep_ids: bool = False) -> DataFrame:
    """A row per document: id, start, n_tokens, ids_crc32, ids (if asked for)."""
    parts = max(1, min(files.count(), MOST_READERS))
    return files.select("file", "start").repartition(parts).mapInArrow(
        tidy(_reader(keep_ids)), "id long, start long, n_tokens long, ids_crc32 long, ids array<int>")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", **options) -> DataFrame:
    read = read_files(write_files(docs, path, id_col=id_col, **options))
    return read.select(F.col("id").alias(id_col), "start", "n_tokens", "ids_crc32")
