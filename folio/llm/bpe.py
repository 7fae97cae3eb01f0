"""BPE encoding and decoding of word-end vocabularies, with a segment tree over adjacent pair ranks.

Encoding: special tokens are cut out; the rest is put in NFC, lower-cased and split into words (beyond Latin letters by the library's own Unicode tables); every byte of a word
is a symbol, the last one with the word-end mark.  The leaves of a word's segment tree hold (rank, place) of its
adjacent pairs, each inner node the least below it, so the root yields the leftmost pair of lowest rank.  A merge
changes three leaves; each is updated along its path to the root.  This goes on until the root holds no pair.
Trees of many words (of the same size) are held in one numpy array and advance together.

Blank-free chunks recur, so a task keeps the ids of those it has met, up to ``CACHE_WORDS`` and ``CACHE_CHARS``, and then starts
afresh; this bounds memory and changes no result.

Defined cases: null text is empty and has no ids; the ids of an unknown byte symbol (none in a byte-complete
vocabulary) raise; other columns pass through ``encode``.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType
from tokenizers import Regex, normalizers, pre_tokenizers

from .common import slices

CACHE_WORDS, CACHE_CHARS = 250_000, 8 << 20
SLICE_BYTES = 2 << 20
CELLS = 1 << 20  # leaves of trees held at once
END = "</w>"
_FAR = re.compile("[\u0130\u0250-\u1dff\u2c00-\U0010ffff]")  # beyond the Latin letters that lower-case alike everywhere
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # fixed value: the vocabulary's split pattern


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    for k, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + k)
    return [out[b] for b in range(256)]


class Vocabulary:
    """Ids, merges and special tokens of a tokenizer file; ``path`` is a parameter of the job, not kept here."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.tokens = [""] * (max([*ids.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for t, k in ids.items():
            self.tokens[k] = t
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for t, k in self.special.items():
            self.tokens[k] = t
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)  # by rank
        key = np.array([ids[a] * len(self.tokens) + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks = key[order], order
        symbols = byte_symbols()
        self.inner = np.array([ids.get(c, -1) for c in symbols], np.int64)
        self.last = np.array([ids.get(c + END, -1) for c in symbols], np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 where it cannot be merged."""
        key = a * len(self.tokens) + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.ranks[at], -1)


def _merge(v: Vocabulary, symbols: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge words of equal tree size; ``symbols`` is (words, leaves + 1), -1 beyond a word's end.

    Returns all ids in order and how many each word has."""
    n, width = symbols.shape
    none = np.int64(1) << 62
    sym = np.concatenate([symbols, np.full((n, 2), -1)], axis=1)
    after = np.tile(np.arange(1, width + 3), (n, 1))
    after[:, width + 1] = width + 1
    before = np.tile(np.arange(-1, width + 1), (n, 1))
    place_bits = np.int64(max(1, leaves).bit_length())

    def value(rank, place):
        return np.where(rank >= 0, (rank << place_bits) | place, none)

    tree = np.full((n, 2 * leaves), none)
    tree[:, leaves:] = value(v.rank(symbols[:, :leaves], symbols[:, 1:leaves + 1]), np.arange(leaves))
    level = leaves
    while level > 1:
        level //= 2
        tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
    w = np.flatnonzero(tree[:, 1] < none) if leaves > 1 else np.flatnonzero(tree[:, leaves] < none)
    while len(w):
        root = tree[w, 1]
        place, rank = root & ((np.int64(1) << place_bits) - 1), root >> place_bits
        new = v.merged[rank]
        gone = after[w, place]
        follow = after[w, gone]
        prior = before[w, place]
        sym[w, place], sym[w, gone] = new, -1
        after[w, place] = follow
        before[w, follow] = place
        right = v.rank(new, sym[w, follow])
        left = np.where(prior >= 0, v.rank(np.where(prior >= 0, sym[w, prior], -1), new), -1)
        for at, val, use in ((gone, none, gone < leaves), (place, value(right, place), None), (prior, value(left, prior), prior >= 0)):
            if use is None:
                r, node, x = w, place + leaves, val
            else:
                r, node, x = w[use], at[use] + leaves, val if np.ndim(val) == 0 else val[use]
            tree[r, node] = x
            for _ in range(leaves.bit_length() - 1):
                node = node >> 1
                tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
        w = w[tree[w, 1] < none]
    flat = sym[:, :width]
    keep = flat >= 0
    return flat[keep], keep.sum(axis=1)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[0] .. starts[0] + sizes[0] - 1, then those of the next, and so on."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def merge_words(v: Vocabulary, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words (none empty) in order, and how many each has."""
    raw = [w.encode() for w in words]
    lens = np.fromiter(map(len, raw), np.int64, len(raw))
    depth = np.ceil(np.log2(np.maximum(lens - 1, 1))).astype(np.int64)  # a tree has 2 ** depth leaves
    counts, done = np.zeros(len(raw), np.int64), []
    for size in np.unique(depth):
        leaves = 1 << int(size)
        same = np.flatnonzero(depth == size)
        step = max(1, CELLS // leaves)
        for k in range(0, len(same), step):
            some = same[k:k + step]
            n = lens[some]
            symbols = np.full((len(some), leaves + 1), -1, np.int64)
            cells = np.frombuffer(b"".join([raw[i] for i in some.tolist()]), np.uint8)
            row = np.repeat(np.arange(len(some)), n)
            ids = v.inner[cells]
            ids[np.cumsum(n) - 1] = v.last[cells[np.cumsum(n) - 1]]
            if (ids < 0).any():
                raise ValueError("the vocabulary lacks a byte")
            symbols[row, np.arange(len(cells)) - np.repeat(np.cumsum(n) - n, n)] = ids
            flat, counts[some] = _merge(v, symbols, leaves)
            done.append((some, flat))
    out = np.empty(int(counts.sum()), np.int64)
    starts = np.cumsum(counts) - counts
    for some, flat in done:
        out[_spread(starts[some], counts[some])] = flat
    return out, counts


def _latin_1(text: str) -> bool:
    """No character beyond U+00FF: none is far, and all are in NFC."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _filled(numbers: list[int | None], following: int) -> np.ndarray:
    """The numbers, with those from ``following`` on in place of None."""
    out = np.array([-1 if k is None else k for k in numbers], np.int64)
    gaps = np.flatnonzero(out < 0)
    out[gaps] = following + np.arange(len(gaps))
    return out


class WordCoder:
    """Encodes texts by their blank-free chunks; ``encode_words`` gives the ids of the words of new chunks.  ``room`` widens the cache."""

    def __init__(self, special: dict[str, int], encode_words: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], room: int = 1):
        self.special, self.encode_words, self.room = special, encode_words, room
        self.words = regex.compile(WORD + r"|\n")  # chunks hold no line end, so it can stand between them
        self.far_words = pre_tokenizers.Split(Regex(WORD), "removed", invert=True)
        self.blank = regex.compile(r"\s+")
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.clear()

    def clear(self):
        self.known: dict[str, int] = {}
        self.pool, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.chars = 0

    def split(self, text: str) -> str | list[str]:
        """The normalised text, whose chunks lie between ASCII blanks, or, where that is not so, its chunks in order.
        A special token is one item of its own, after a NUL and a blank."""
        if self.cut and "<|" in text and len(parts := self.cut.split(text)) > 1:
            out = []
            for p in parts:
                own = "\0 " + p if p in self.special else self.split(p)
                out += own if isinstance(own, list) else [own] if p in self.special else own.split()
            return out
        far_blanks = False
        if not text.isascii():
            if _latin_1(text):
                far_blanks = "\x85" in text or "\xa0" in text
            else:
                if _FAR.search(text):  # the library's own Unicode tables
                    text = self.normal.normalize_str(text)
                elif not unicodedata.is_normalized("NFC", text):
                    text = unicodedata.normalize("NFC", text)
                far_blanks = True
        text = text.lower()
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:  # blanks to str.split, but not to the split pattern
            return [x for x in self.blank.split(text) if x]
        return text.split() if far_blanks else text

    def learn(self, new: list[str]):
        joined = "\n".join(new)
        odd = [k for k, x in enumerate(new) if x.startswith("\0 ") or _FAR.search(x)] if "\0 " in joined or _FAR.search(joined) else []
        order = np.delete(np.arange(len(new)), odd)  # chunks split all at once, then the others
        flat = self.words.findall("".join([new[k] + "\n" for k in order.tolist()]) if odd else joined + "\n")
        for k in odd:
            flat += [new[k]] if new[k].startswith("\0 ") else [w for w, _ in self.far_words.pre_tokenize_str(new[k])]
            flat.append("\n")
        marks = {"\0 " + t for t in self.special}
        words = dict.fromkeys(flat)
        del words["\n"]
        special = [x for x in marks if x in words]
        words = [x for x in words if x not in marks]
        ids, n = self.encode_words(words)
        ids = np.concatenate([ids, np.array([self.special[x[2:]] for x in special], np.int64)])
        n = np.concatenate([n, np.ones(len(special), np.int64), np.zeros(1, np.int64)])
        starts = np.cumsum(n) - n
        at = dict(zip([*words, *special, "\n"], range(len(n))))
        places = np.fromiter(map(at.__getitem__, flat), np.int64, len(flat))
        ends = np.cumsum(n[places])[places == len(n) - 1]
        place = np.empty((2, len(new)), np.int64)
        place[:, np.append(order, np.array(odd, np.int64))] = np.append(0, ends[:-1]), np.diff(ends, prepend=0)
        self.starts = np.append(self.starts, len(self.pool) + place[0])
        self.sizes = np.append(self.sizes, place[1])
        self.pool = np.concatenate([self.pool, ids[_spread(starts[places], n[places])].astype(np.int32)])
        self.chars += sum(map(len, new))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): all ids in order, and where each text's begin and end."""
        if len(self.known) > CACHE_WORDS * self.room or self.chars > CACHE_CHARS * self.room:
            self.clear()
        split = [self.split(t) for t in texts]
        whole = np.fromiter((isinstance(x, str) for x in split), bool, len(split))
        lists = pa.compute.ascii_split_whitespace(pa.array([x for x in split if isinstance(x, str)], pa.string()))
        coded = lists.flatten().dictionary_encode()  # few chunks are looked up more than once
        names, others = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), [x for x in split if isinstance(x, list)]
        numbers = list(map(self.known.get, names))
        new = [x for x, k in zip(names, numbers) if k is None]
        if others:
            new = [x for x in dict.fromkeys(itertools.chain(new, *others)) if x not in self.known]
        if new:
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.learn(new)
            numbers = list(map(self.known.__getitem__, names)) if others else _filled(numbers, len(self.known) - len(new))
        sizes = np.empty(len(split), np.int64)
        sizes[whole] = lists.value_lengths().to_numpy(zero_copy_only=False)
        sizes[~whole] = np.fromiter(map(len, others), np.int64, len(others))
        at = np.array(numbers, np.int64)[coded.indices.to_numpy(zero_copy_only=False)]
        if others:
            starts, near = np.cumsum(sizes) - sizes, at
            at = np.empty(int(sizes.sum()), np.int64)
            at[_spread(starts[whole], sizes[whole])] = near
            rest = _spread(starts[~whole], sizes[~whole])
            at[rest] = np.fromiter(map(self.known.__getitem__, itertools.chain.from_iterable(others)), np.int64, len(rest))
        n = self.sizes[at]
        ends = np.append(0, np.cumsum(n))
        return (self.pool[_spread(self.starts[at], n)],
                ends[np.append(0, np.cumsum(sizes))])


_CODERS: dict[str, tuple[Vocabulary, WordCoder]] = {}


def coder(path: str) -> tuple[Vocabulary, WordCoder]:
    """The vocabulary and coder of a file, loaded once in each Python worker."""
    if path not in _CODERS:
        v = Vocabulary(path)
        _CODERS[path] = v, WordCoder(v.special, lambda words: merge_words(v, words))
    return _CODERS[path]


def text_slices(b: pa.RecordBatch, at: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Bounded parts of a batch with their texts (null: empty)."""
    texts = b.column(at)
    sizes = np.append(0, np.cumsum(pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)))
    for i, j in slices(sizes, SLICE_BYTES):
        part = b.slice(i, j - i)
        yield part, [x or "" for x in part.column(at).to_pylist()]


def _encoder(path: str, at: int, keep: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, c = coder(path)
        for b in batches:
            for part, texts in text_slices(b, at):
                ids, offsets = c.encode(texts)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keep), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))],
                    names=names)
    return run


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", drop_text: bool = True) -> DataFrame:
    """``docs`` with its ids as ``ids_col`` (array of int), in place of the text or beside it."""
    at = docs.columns.index(text_col)
    keep = [k for k, c in enumerate(docs.columns) if not (drop_text and c == text_col)]
    fields = [docs.schema.fields[k] for k in keep]
    run = _encoder(path, at, keep, [f.name for f in fields] + [ids_col])
    return docs.mapInArrow(run, StructType(fields).add(ids_col, ArrayType(IntegerType())))


def decode(ids: list[int], v: Vocabulary) -> str:
    """Tokens joined by a blank, as a tokenizer without a decoder does; special tokens are kept."""
    return " ".join([v.tokens[k] for k in ids])


def _digester(path: str):
    """(id, n_tokens, ids_sha256, decoded_sha256) of batches (id, ids)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, _ = coder(path)
        table = np.array([t.encode() for t in v.tokens], dtype=object)
        for b in batches:
            col = b.column(1)
            off = col.offsets.to_numpy()
            ids = col.values.to_numpy(zero_copy_only=False)
            shas, back = [], []
            for i, j in zip(off[:-1], off[1:]):
                own = ids[i:j]
                shas.append(hashlib.sha256(own.astype("<u4").tobytes()).hexdigest())
                back.append(hashlib.sha256(b" ".join(table[own].tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(off).astype(np.int64)), pa.array(shas, pa.string()),
                                              pa.array(back, pa.string())], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


_DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def digests(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """id, n_tokens, ids_sha256 (of little-endian unsigned 32-bit ids), decoded_sha256 (of the text decoded from them)."""
    kind = encoded.schema[id_col].dataType.simpleString()
    out = encoded.select(F.col(id_col), F.col(ids_col)).mapInArrow(_digester(path), f"id {kind}, {_DIGESTS}")
    return out.withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``digests`` of ``encode``, batch by batch in one Python worker, so that no task needs two."""
    kind = docs.schema[id_col].dataType.simpleString()
    encoder, digester = _encoder(path, 1, [0], ["id", "ids"]), _digester(path)
    out = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(lambda batches: digester(encoder(batches)), f"id {kind}, {_DIGESTS}")
    return out.withColumnRenamed("id", id_col)
