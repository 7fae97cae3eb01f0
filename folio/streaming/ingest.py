"""Checkpointed incremental ingest: pages arriving as files -> records -> store; documents -> chunks -> vectors.

What has been seen is keyed state of the stream (RocksDB, in the checkpoint folder), not the store: no batch reads
the store.  Records are grouped by buckets of their fingerprint; the state holds the digests of a bucket's stored fingerprints, and of
a new one's records in a batch the first by (page URL, row position) is given out.  A record passes that step as one text, since each
column of each row is converted on its own there.  Chunks are grouped by content id, whose repeats are equal.

A batch writes its own folder ``run=R/batch_id=N`` in overwrite mode, so a batch replayed after the loss of an
executor or of the driver rewrites the same rows.  ``R`` belongs to the checkpoint: a stream with a fresh checkpoint over an
old store takes the ids stored by then as its initial state, read once, and writes beside them.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from folio.operators import chunking as C
from folio.operators import listing as L
from folio.operators import store as S
from folio.operators.embedding import Embedder, hashing
from folio.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PAGE_SCHEMA = "page_id bigint, url string, html string"


BUCKETS = 1 << 12  # of fingerprints; belongs to a checkpoint
DIGEST = 32  # bytes


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket")


def _digest(key: str) -> Column:
    return F.coalesce(F.unhex(F.sha2(F.col(key), 8 * DIGEST)), F.lit(bytes(DIGEST))).alias("digest")


def _first(row: Row) -> tuple:
    return (row.url is None, row.url or "", row.row_pos is None, row.row_pos or 0)


class FirstWriter(StatefulProcessor):
    """Gives out the first record of every fingerprint, once; keeps the digests of a bucket's fingerprints."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("digests", T.StructType([T.StructField("digests", T.BinaryType())]))

    def _held(self) -> bytes:
        found = self.seen.get()
        return b"" if found is None else bytes(found[0])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held, best = self._held(), {}
        stored = {held[k:k + DIGEST] for k in range(0, len(held), DIGEST)}
        for row in rows:  # one row a new fingerprint is held
            digest = bytes(row.digest)
            if digest not in stored and (digest not in best or _first(row) < _first(best[digest])):
                best[digest] = row
        if best:
            self.seen.update((held + b"".join(best),))
        for row in best.values():
            yield Row(record=row.record)

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.seen.update((self._held() + b"".join(map(bytes, initialState.digests)),))

    def close(self) -> None:
        pass


def _first_records(recs: DataFrame, stored: DataFrame | None) -> DataFrame:
    """The first record of every ``_id`` that is not in ``stored`` (a frame of ids), once in the stream's life."""
    packed = recs.select(_bucket("_id"), _digest("_id"), F.col("source_page_url").alias("url"), "row_pos",
                         F.to_json(F.struct(*recs.columns), {"ignoreNullFields": "false"}).alias("record"))
    if stored is not None:
        stored = stored.select(_bucket("_id"), _digest("_id")).groupBy("bucket").agg(F.collect_set("digest").alias("digests")).groupBy("bucket")
    new = packed.groupBy("bucket").transformWithState(FirstWriter(), "record string", "Append", "None", initialState=stored)
    whole = F.from_json("record", recs.schema, {"mode": "FAILFAST", "maxStringLen": str((1 << 31) - 1)})
    return new.select(whole.alias("r")).select("r.*")


class _keyed_state:
    """The RocksDB state provider while a stream starts; the session's own setting afterwards."""

    KEY = "spark.sql.streaming.stateStore.providerClass"

    def __init__(self, spark: SparkSession):
        self.spark, self.old = spark, spark.conf.get(self.KEY, None)

    def __enter__(self):
        self.spark.conf.set(self.KEY, STATE_PROVIDER)

    def __exit__(self, *_):
        if self.old is None:
            self.spark.conf.unset(self.KEY)
        else:
            self.spark.conf.set(self.KEY, self.old)


def _run_of(checkpoint: str) -> str:
    return "r" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _stored_ids(spark: SparkSession, store_path: str, checkpoint: str, key: str) -> DataFrame | None:
    """Ids that other runs have stored; read once, when a stream starts."""
    store = S.read_store(spark, store_path)
    return None if store is None else store.where(F.col("run") != _run_of(checkpoint)).select(key).distinct()


def _batch_folder(store_path: str, checkpoint: str):
    run = _run_of(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{store_path.rstrip('/')}/run={run}/batch_id={batch_id}")
    return write


def start_ingest(spark: SparkSession, pages_dir: str, store_path: str, checkpoint: str, schema: str = PAGE_SCHEMA, files_per_batch: int = 64):
    """Start the stream over a folder of page files; returns the StreamingQuery."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(pages_dir)
    recs = S.with_store_keys(L.extract_records(src))
    new = _first_records(recs, _stored_ids(spark, store_path, checkpoint, "_id"))
    with _keyed_state(spark):
        return (new.writeStream.foreachBatch(_batch_folder(store_path, checkpoint)).outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _land(df: DataFrame, folder: str, order: str, waves: int) -> int:
    """Write ``df`` in ``waves`` waves by ``order``, one after the other and each by many tasks; returns the files of a wave."""
    spark = df.sparkSession
    each = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // waves)
    ranged = df.repartitionByRange(waves * each, order).withColumn("_wave", F.floor(F.spark_partition_id() / each)).checkpoint(eager=True)
    for k in range(waves):
        ranged.where(F.col("_wave") == k).drop("_wave").write.mode("append").parquet(folder)
    return each


def ingest_pages_stream(spark: SparkSession, pages: DataFrame, waves: int = 3, files_per_batch: int | None = None) -> DataFrame:
    """Land ``pages`` in waves by URL, run the stream to completion, return the store (with run and batch_id)."""
    root = scratch_path(spark, "ingest")
    each = _land(pages, f"{root}/pages", "url", waves)
    start_ingest(spark, f"{root}/pages", f"{root}/store", f"{root}/_checkpoint", PAGE_SCHEMA, files_per_batch or each).awaitTermination()
    return spark.read.parquet(f"{root}/store")


def start_embed(spark: SparkSession, docs_dir: str, store_path: str, checkpoint: str, embedder: Embedder, separator: str = "\n",
                size: int = 1000, files_per_batch: int = 64):
    """Start a stream that chunks documents and embeds each chunk whose content id is new; returns the StreamingQuery."""
    src = spark.readStream.schema("doc_id bigint, text string").option("maxFilesPerTrigger", files_per_batch).parquet(docs_dir)
    chunks = C.chunk_ids(C.chunk_text(src, "text", "doc_id", separator, size, 0))
    write = _batch_folder(store_path, checkpoint)
    stored = _stored_ids(spark, store_path, checkpoint, "chunk_id")
    if stored is not None:
        chunks = chunks.join(stored.checkpoint(eager=True), "chunk_id", "left_anti")
    new = chunks.dropDuplicates(["chunk_id"])

    def embed(batch: DataFrame, batch_id: int) -> None:
        batch = batch.checkpoint(eager=True)  # an embedder may read it twice, the state must not be
        write(embedder(batch, "chunk", ["chunk_id", "doc_id", "chunk_pos"], "embedding"), batch_id)
    with _keyed_state(spark):
        return (new.writeStream.foreachBatch(embed).outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def embed_documents_stream(spark: SparkSession, docs: DataFrame, separator: str = "\n", size: int = 1000, dim: int = 64,
                           waves: int = 3, files_per_batch: int | None = None, embedder: Embedder | None = None) -> DataFrame:
    """Land documents in waves; a checkpointed stream chunks them and embeds only chunks whose content id has no vector
    yet; returns the vector store."""
    root = scratch_path(spark, "embed")
    each = _land(docs.select("doc_id", "text"), f"{root}/docs", "doc_id", waves)
    start_embed(spark, f"{root}/docs", f"{root}/vectors", f"{root}/_checkpoint", embedder or hashing(dim), separator, size,
                files_per_batch or each).awaitTermination()
    return spark.read.parquet(f"{root}/vectors")
