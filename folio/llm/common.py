"""Helpers shared by the corpus operators: shared storage, Arrow text buffers, word splitting and hashing.

Words are found on the UTF-8 bytes of a whole Arrow slice at once.  Every word class used here treats all
bytes from 0x80 up alike, so byte classes and character classes agree.
"""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from folio.session import ensure_checkpoint_dir

SLICE_BYTES = 1 << 18  # text bytes handled at once in a task; a longer single text is one slice
SLICE_ROWS = 1 << 14
BATCH_BYTES = 4 << 20  # of an Arrow batch; a longer single row is one batch
MULT = np.uint64(0x9E3779B97F4A7C13)  # 3 modulo 8, so that powers of it repeat as late as they can
MULT_INV = np.uint64(pow(int(MULT), -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bounded_batches(spark: SparkSession, most_bytes: int = BATCH_BYTES) -> None:
    """Let Spark hand texts to Python in batches of few bytes, from now on in this session: with the default of 64 MB a
    worker and the JVM beside it hold some hundred MB of texts at once."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most_bytes))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives a lost executor."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


try:
    _TRIM = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # not glibc
    _TRIM = None


def release_memory() -> None:
    """Give freed memory back to the system: Spark keeps Python workers for later tasks, and they keep what they once held."""
    _POWERS.clear()
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def tidy(task):
    """A ``mapInArrow`` function that releases memory once its partition is done."""
    @functools.wraps(task)
    def run(batches):
        yield from task(batches)
        release_memory()
    return run


def fresh(columns, *names: str) -> list[str]:
    """Names that clash with none of ``columns``, ignoring case."""
    taken = {c.lower() for c in columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply), wrapping."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_HASH = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column = column.cast(pa.string())
        kind = np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, most_bytes: int = SLICE_BYTES, most_rows: int = SLICE_ROWS) -> Iterator[tuple[int, int]]:
    """Row ranges of bounded bytes and rows that cover all rows in order."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most_bytes, "right")) - 1
        j = min(max(j, i + 1), n, i + most_rows)
        yield i, j
        i = j


def byte_table(separators: bytes) -> np.ndarray:
    """Lower-casing (A-Z) table in which separator bytes become 0."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    t[list(separators)] = 0
    return t


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        for name, m in (("up", MULT), ("down", MULT_INV)):
            p = np.full(n, m, np.uint64)
            p[0] = 1
            _POWERS[name] = np.cumprod(p, dtype=np.uint64)
    return _POWERS["up"], _POWERS["down"]


def split_words(data: np.ndarray, offsets: np.ndarray, lut: np.ndarray):
    """(low, starts, ends, rows): lower-cased bytes and the words of each row, in order."""
    low = lut[data]
    word = low != 0
    if not len(word):
        z = np.zeros(0, np.int64)
        return low, z, z, z
    first = np.zeros(len(word) + 1, bool)
    first[offsets] = True
    before = np.empty(len(word), bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | first[:-1]))
    after = np.empty(len(word), bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | first[1:])) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return low, starts, ends, rows


def word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word, from running sums over the slice."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(low) + 1)
    total = np.zeros(len(low) + 1, np.uint64)
    np.cumsum(BYTE_HASH[low] * up[:len(low)], dtype=np.uint64, out=total[1:])
    return mix64((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def row_counts(rows: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(rows, minlength=n).astype(np.int64)
