"""Text chunking as a per-document fold (no UDF, no shuffle).

Greedy packing is sequential inside one document, so it is an ``aggregate``
over the document's pieces; documents are independent rows, so the work
spreads over the cluster with the scan's partitioning.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.functions.text import py_strip
from folio.functions.util import let


def _pieces(text: Column, separator: str) -> Column:
    return F.filter(F.split(text, re.escape(separator) if separator else "", -1), lambda p: p != "")


def _pack_no_overlap(pieces: Column, sep: str, size: int) -> Column:
    seplen = len(sep)
    init = F.struct(F.array().cast("array<string>").alias("docs"), F.lit("").alias("cur"),
                    F.lit(False).alias("has"), F.lit(0).alias("total"))

    def step(acc, d):
        L = F.length(d)
        over = acc["has"] & (acc["total"] + L + seplen > size)
        return (F.when(over, F.struct(F.concat(acc["docs"], F.array(acc["cur"])).alias("docs"), d.alias("cur"),
                                      F.lit(True).alias("has"), L.alias("total")))
                .when(acc["has"], F.struct(acc["docs"].alias("docs"), F.concat(acc["cur"], F.lit(sep), d).alias("cur"),
                                           F.lit(True).alias("has"), (acc["total"] + L + seplen).alias("total")))
                .otherwise(F.struct(acc["docs"].alias("docs"), d.alias("cur"), F.lit(True).alias("has"),
                                    L.alias("total"))))

    return F.aggregate(pieces, init, step,
                       lambda acc: F.when(acc["has"], F.concat(acc["docs"], F.array(acc["cur"]))).otherwise(acc["docs"]))


def _pack_overlap(pieces: Column, sep: str, size: int, overlap: int) -> Column:
    """As without overlap, but a new chunk begins with the last pieces of the one before whose length is at most ``overlap``.

    ``ends`` holds, for each piece of the current chunk, the length of all pieces of the text up to its end, so the
    length of any number of last pieces is one subtraction."""
    seplen = len(sep)
    init = F.struct(F.array().cast("array<string>").alias("docs"), F.array().cast("array<string>").alias("cur"),
                    F.array().cast("array<int>").alias("ends"), F.lit(0).alias("total"))

    def step(acc, d):
        L = F.length(d)
        cur, ends, n = acc["cur"], acc["ends"], F.size(acc["cur"])
        done = F.coalesce(F.try_element_at(ends, F.lit(-1)), F.lit(0))  # length of all pieces before this one

        def last(k):
            """Length of the pieces from place ``k`` on, joined."""
            before = F.when(k == 0, F.element_at(ends, 1) - F.length(F.element_at(cur, 1))).otherwise(F.element_at(ends, k))
            return F.when(k >= n, F.lit(0)).otherwise(done - before + seplen * (n - k - 1))

        over = (n > 0) & (acc["total"] + L + seplen > size)
        fits = lambda k: let(last(k), lambda t: (t <= overlap) & ((t == 0) | (t + L + F.when(k < n, seplen).otherwise(0) <= size)))
        keep = F.when(over, F.element_at(F.filter(F.sequence(F.lit(0), n), fits), 1)).otherwise(F.lit(0))

        def grown(k):
            rest = F.greatest(n - k, F.lit(0))
            total = F.when(over, last(k)).otherwise(acc["total"]) + L + F.when(rest > 0, seplen).otherwise(0)
            return F.struct(
                F.when(over, F.concat(acc["docs"], F.array(F.array_join(cur, sep)))).otherwise(acc["docs"]).alias("docs"),
                F.concat(F.slice(cur, k + 1, rest), F.array(d)).alias("cur"),
                F.concat(F.slice(ends, k + 1, rest), F.array(done + L)).alias("ends"), total.alias("total"))
        return let(keep, grown)

    return F.aggregate(pieces, init, step,
                       lambda acc: F.when(F.size(acc["cur"]) > 0,
                                          F.concat(acc["docs"], F.array(F.array_join(acc["cur"], sep))))
                       .otherwise(acc["docs"]))


def chunk_array(text, separator: str = "\n\n", chunk_size: int = 1000, chunk_overlap: int = 0) -> Column:
    """Chunks of one text: split on ``separator``, drop empty pieces, greedily pack
    pieces joined by the separator while the length stays <= ``chunk_size``
    (a longer piece stays whole), strip each chunk, drop empty chunks."""
    t = text if isinstance(text, Column) else F.col(text)
    pieces = _pieces(t, separator)
    packed = (_pack_no_overlap(pieces, separator, chunk_size) if chunk_overlap <= 0
              else _pack_overlap(pieces, separator, chunk_size, chunk_overlap))
    return F.filter(F.transform(packed, lambda c: py_strip(c)), lambda c: c != "")


def chunk_text(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", separator: str = "\n\n",
               chunk_size: int = 1000, chunk_overlap: int = 0, keep: list[str] | None = None) -> DataFrame:
    """One row per chunk: (id, chunk_pos, chunk, *keep); chunk_pos is 0-based."""
    keep = keep or []
    arr = chunk_array(F.col(text_col), separator, chunk_size, chunk_overlap)
    return docs.select(id_col, *keep, F.posexplode(arr).alias("chunk_pos", "chunk")) \
        .select(id_col, F.col("chunk_pos").cast("int").alias("chunk_pos"), "chunk", *keep)


def recursive_spans(text: str, separators: tuple[str, ...], size: int, overlap: int) -> list[tuple[int, int]]:
    """Spans [start, end) of one text's chunks, before stripping.

    A text is cut before every occurrence of the first separator that it holds ("" cuts between characters), so
    pieces keep their separator and follow each other.  Pieces longer than ``size`` are cut again with the
    next separators.  Neighbours are joined while they fit; the next chunk starts with as many of the last pieces
    as fit into ``overlap`` and still leave room for the piece that follows."""
    def pieces(start: int, end: int, level: int) -> list[tuple[int, int]]:
        while level < len(separators) - 1 and text.find(separators[level], start, end) < 0:
            level += 1
        sep = separators[level] if level < len(separators) else ""
        if not sep:
            return [(k, k + 1) for k in range(start, end)]
        cuts, at = [start], text.find(sep, start, end)
        while at >= 0:
            if at > start:
                cuts.append(at)
            at = text.find(sep, at + len(sep), end)
        out = list(zip(cuts, [*cuts[1:], end]))
        return [q for p in out for q in (pieces(*p, level + 1) if p[1] - p[0] > size and level + 1 < len(separators) else [p])]

    chunks: list[tuple[int, int]] = []
    held: list[tuple[int, int]] = []
    for p in pieces(0, len(text), 0) if text else []:
        if held and p[1] - held[0][0] > size:
            chunks.append((held[0][0], held[-1][1]))
            while held and (held[-1][1] - held[0][0] > overlap or p[1] - held[0][0] > size):
                held.pop(0)
        held.append(p)
    if held:
        chunks.append((held[0][0], held[-1][1]))
    return chunks


def chunk_recursive(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    separators=("\n\n", "\n", " ", ""), chunk_size: int = 100, chunk_overlap: int = 20) -> DataFrame:
    """Coarse-to-fine chunks: (id, chunk_pos, chunk, start_index), stripped, empty ones dropped; ``start_index``
    is the chunk's own place in the text, in characters.  One pass over the documents, no shuffle."""
    seps = tuple(separators)

    @F.arrow_udf("array<struct<chunk:string,start_index:int>>")
    def cut(texts: pa.Array) -> pa.Array:
        every = []
        for t in texts.to_pylist():
            own = []
            for a, b in recursive_spans(t or "", seps, chunk_size, chunk_overlap):
                body = t[a:b]
                if body.strip():
                    own.append({"chunk": body.strip(), "start_index": a + len(body) - len(body.lstrip())})
            every.append(own)
        return pa.array(every, pa.list_(pa.struct([("chunk", pa.string()), ("start_index", pa.int32())])))

    out = docs.select(id_col, F.posexplode(cut(F.col(text_col))).alias("chunk_pos", "c"))
    return out.select(id_col, "chunk_pos", "c.chunk", "c.start_index")


def first_chunk(chunks: DataFrame) -> DataFrame:
    return chunks.where(F.col("chunk_pos") == 0)


def attach_metadata(chunks: DataFrame, metadata_json: str | None = None, by: DataFrame | None = None,
                    on: str | None = None) -> DataFrame:
    """Every chunk carries its document's metadata: one literal JSON object, or a per-key table joined in."""
    if by is not None:
        return chunks.join(by, on, "left")
    return chunks.withColumn("metadata", F.lit(metadata_json))


def chunk_ids(chunks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Content id per chunk: sha256 of ``doc_id|chunk_pos|chunk`` (reruns give the same ids)."""
    return chunks.withColumn("chunk_id", F.sha2(F.concat_ws("|", F.col(id_col).cast("string"),
                                                             F.col("chunk_pos").cast("string"), F.col("chunk")), 256))


def append_chunks(chunks: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Append chunks with their content ids to a Parquet folder (a rerun appends the same ids again)."""
    chunk_ids(chunks, id_col).write.mode("append").parquet(path)
