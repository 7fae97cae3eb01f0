"""Exact deduplication by two-pass Bloom filtering.

Pass 1 hashes every text (64 bits, in the JVM) and sets ``PROBES`` bits per row in a filter split into
segments of 2**16 bits.  Tasks send sparse bit positions; a task that owns a segment keeps two bitmaps, "hit"
and "hit at least twice".  The second one is the filter of possibly repeated hashes: a text that occurs twice
hits all its bits twice, so none is missed.  Pass 2 probes it for every row; rows outside go straight
through, the others are grouped by SHA-256.

The filter is broadcast, so its size is bounded: 16 bits a row, at most ``max_bits`` (2**31 bits, 256 MB).
Beyond 10**8 rows or so it fills up: more rows are then grouped (by digest), and the result stays the same.

Defined cases: null text equals empty text.  A null id is smaller than any id.  Of rows equal in text, the one
with the largest id stays; of rows equal in text and id, ``assign`` marks each as kept and ``dedup`` returns
one of them (the one with the largest row hash).  Other columns, of any name, pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored, tidy

SEGMENT_BITS = 1 << 16
PROBES = 2
BITS_PER_ROW = 16
MAX_BITS = 1 << 31
BUFFER = 1 << 18  # hashes held in a task before their bits are sent


def _probe(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """The ``PROBES`` bit numbers of each hash; ``bits`` is a power of two."""
    h = h.astype(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64) for i in range(PROBES)]


def _send_bits(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush():
            at = np.sort(np.concatenate(_probe(np.concatenate(held), bits)))
            seg, low = at // SEGMENT_BITS, (at % SEGMENT_BITS).astype("<u2")
            first = np.flatnonzero(np.diff(seg, prepend=-1))
            ends = np.append(first[1:], len(seg))
            return pa.RecordBatch.from_arrays(
                [pa.array(seg[first]), pa.array([low[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())],
                names=["seg", "at"])

        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False))
            if sum(map(len, held)) >= BUFFER:
                yield flush()
                held = []
        if sum(map(len, held)):
            yield flush()
    return run


def _merge_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segment bitmaps of bits hit at least twice; keeps two bitmaps for each segment of the partition."""
    once: dict[int, np.ndarray] = {}
    twice: dict[int, np.ndarray] = {}
    for b in batches:
        for seg, at in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if seg not in once:
                once[seg], twice[seg] = np.zeros(SEGMENT_BITS, bool), np.zeros(SEGMENT_BITS, bool)
            p = np.frombuffer(at, "<u2")
            twice[seg][p[once[seg][p]]] = True
            twice[seg][p[1:][p[1:] == p[:-1]]] = True
            once[seg][p] = True
    for seg, t in twice.items():
        if t.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array([seg], pa.int64()), pa.array([np.packbits(t, bitorder="little").tobytes()], pa.binary())],
                names=["seg", "bitmap"])


def filter_bits(rows: int, bits_per_row: int = BITS_PER_ROW, max_bits: int = MAX_BITS) -> int:
    bits = SEGMENT_BITS
    while bits < rows * bits_per_row and bits < max_bits:
        bits *= 2
    return bits


def repeated_filter(hashes: DataFrame, bits: int, make=iter):
    """Pass 1: a broadcast bitmap of bits that at least two rows of ``hashes`` hit.

    ``hashes`` is one long column, or any rows from whose batches ``make`` makes batches of such a column."""
    sc, send = hashes.sparkSession.sparkContext, _send_bits(bits)
    parts = max(1, min(bits // SEGMENT_BITS, int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    merged = (hashes.mapInArrow(tidy(lambda batches: send(make(batches))), "seg long, at binary")
              .repartition(parts, "seg").mapInArrow(tidy(_merge_bits), "seg long, bitmap binary"))
    whole = np.zeros(bits // 8, np.uint8)
    size = SEGMENT_BITS // 8
    for r in merged.collect():  # at most bits / 8 bytes in all
        whole[r.seg * size:(r.seg + 1) * size] = np.frombuffer(r.bitmap, np.uint8)
    return sc.broadcast(whole)


def in_filter(h: np.ndarray, bitmap: np.ndarray, bits: int) -> np.ndarray:
    """Whether all bits of each hash were hit at least twice."""
    found = np.ones(len(h), bool)
    for at in _probe(h, bits):
        found &= (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
    return found


def possibly_repeated(hash_: Column, filt, bits: int) -> Column:
    """Pass 2 for a column of hashes."""
    @F.arrow_udf("boolean")
    def probe(h: pa.Array) -> pa.Array:
        return pa.array(in_filter(h.to_numpy(zero_copy_only=False), filt.value, bits))
    return probe(hash_)


def _filtered(docs: DataFrame, text_col: str, max_bits: int) -> tuple[Column, Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    bits = filter_bits(docs.count(), max_bits=max_bits)
    filt = repeated_filter(docs.select(F.xxhash64(text).alias("h")), bits)
    return text, possibly_repeated(F.xxhash64(text), filt, bits)


def assign(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """A row per input row: id, keep_id, group_size, kept, text_sha256."""
    text, maybe = _filtered(docs, text_col, max_bits)
    marked = stored(docs.select(F.col(id_col).alias("id"), F.sha2(text, 256).alias("sha"), maybe.alias("maybe")), "exact")
    alone = marked.where(~F.col("maybe")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    suspect = marked.where("maybe").select("id", "sha")
    groups = stored(suspect.groupBy("sha").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "exact-groups")
    # stored, so that the join stands on plain scans and Spark can split the rows of a large group
    both = suspect.join(groups, "sha").select(
        "id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "sha")
    return alone.unionByName(both).withColumnsRenamed({"id": id_col, "sha": "text_sha256"})


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """The rows that stay, with the columns of ``docs``; a group is cut down to one row in each task first."""
    cols = docs.columns
    text, maybe = _filtered(docs, text_col, max_bits)
    m, key, best = fresh(cols, "maybe", "sha", "best")
    marked = docs.withColumn(m, maybe)
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    order = F.struct(F.col(f"`{id_col}`"), F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in cols]))
    kept = (marked.where(F.col(m)).withColumn(key, F.sha2(text, 256)).groupBy(key)
            .agg(F.max_by(row, order).alias(best)).select(f"{best}.*"))
    return marked.where(~F.col(m)).drop(m).unionByName(kept)
