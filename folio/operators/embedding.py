"""The embedder slot: any embedder is a function ``(df, text_col, keys, out) -> df`` with a vector column for the keys.

``hashing(dim)`` is the default, feature hashing in Columns.  ``batched(load, dim)`` wraps a model: ``load()`` runs once a task and
returns a function from a list of texts to their vectors.  Texts are embedded once per distinct content, found by SHA-256
of the text, in batches of texts of similar length; the vectors come back to the keys by that digest.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folio.operators.vectors import hash_embed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Embedder = Callable[[DataFrame, str, list[str], str], DataFrame]

BATCH = 64  # texts given to a model at once
HELD_TEXTS, HELD_BYTES = 4096, 16 << 20  # texts that a task sorts by length at a time


def hashing(dim: int = 64) -> Embedder:
    """Feature hashing, see ``hash_embed``."""
    return lambda df, text_col, keys, out: hash_embed(df, text_col, keys, dim, out)


def _embed_task(load: Callable[[], Callable[[list[str]], object]], dim: int, batch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        held: list[tuple[str, str]] = []
        size = 0

        def answer() -> Iterator[pa.RecordBatch]:
            held.sort(key=lambda r: (len(r[1]), r[0]))
            for a in range(0, len(held), batch):
                some = held[a:a + batch]
                vectors = np.asarray(model([t for _, t in some]), np.float64)
                if vectors.shape != (len(some), dim):
                    raise ValueError(f"the embedder gave {vectors.shape} for {len(some)} texts of dimension {dim}")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in some]),
                     pa.FixedSizeListArray.from_arrays(pa.array(vectors.ravel()), dim).cast(pa.list_(pa.float64()))], names=["_sha", "_vector"])

        for b in batches:
            model = model or load()
            for sha, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.append((sha, text))
                size += len(text)
                if len(held) >= HELD_TEXTS or size >= HELD_BYTES:
                    yield from answer()
                    held.clear()
                    size = 0
        if held:
            yield from answer()
    return run


def batched(load: Callable[[], Callable[[list[str]], object]], dim: int, batch: int = BATCH, known: DataFrame | None = None) -> Embedder:
    """Embedder from a model.  ``known`` (sha, vector) holds vectors of texts embedded before, which are taken from there.

    Null text counts as empty; rows that share their keys must share their text."""
    def embed(df: DataFrame, text_col: str, keys: list[str], out: str) -> DataFrame:
        text = F.coalesce(F.col(text_col), F.lit(""))
        rows = df.select(*keys, F.sha2(text, 256).alias("_sha"), text.alias("_text"))
        todo = rows.select("_sha", "_text").dropDuplicates(["_sha"])
        if known is not None:
            todo = todo.join(known.select(F.col("sha").alias("_sha")), "_sha", "left_anti")
        vectors = todo.mapInArrow(_embed_task(load, dim, batch), "_sha string, _vector array<double>").checkpoint(eager=True)
        if known is not None:
            vectors = vectors.unionByName(known.select(F.col("sha").alias("_sha"), F.col("vector").alias("_vector")))
        return rows.select(*keys, "_sha").join(vectors, "_sha").select(*keys, F.col("_vector").alias(out))
    return embed
