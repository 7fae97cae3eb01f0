"""Vectors: a feature-hashing embedder slot, vector entries and k-nearest-neighbour search.

* ``hash_embed`` is the default embedder (model inference is out of scope):
  tokens -> md5 -> bucket and sign -> signed counts (in an Arrow UDF) -> L2
  normalised, with one exchange of partial sums by key.
* ``knn_topk`` broadcasts its queries in bounded blocks; ``knn_topk_batch`` is exact search over pairs of bounded
  blocks; each pair's best candidates are shuffled for the final per-query top-k.
* ``knn_approx`` builds and searches an index of inverted lists.
"""

from __future__ import annotations

import hashlib
import sys
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.operators.vector_index import build_index, exact_topk, search_index
from folio.session import scratch_path

# Ship this module's task-side functions by value, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUERY_BLOCK, VECTOR_BLOCK = 4096, 16384  # rows
CUBE_CELLS = 1 << 22  # differences held at once in a task


def _signed_counts(dim: int):
    """Signed bucket counts of the tokens of each lower-cased text; null and empty texts count nothing."""
    def run(texts: pa.Array) -> pa.Array:
        known: dict[str, tuple[int, int]] = {"": (0, 0)}
        rows, at, signs = [], [], []
        for text in texts.to_pylist():
            tokens = [] if text is None else text.split(" ")
            for t in tokens:
                if t not in known:
                    h = hashlib.md5(t.encode()).hexdigest()
                    known[t] = int(h[:8], 16) % dim, 1 if h[8] < "8" else -1
                bucket, sign = known[t]
                at.append(bucket)
                signs.append(sign)
            rows.append(len(tokens))
        place = np.repeat(np.arange(len(rows)) * dim, rows) + np.array(at, np.int64)
        total = np.bincount(place, np.array(signs, np.float64), minlength=len(rows) * dim).astype(np.int64)
        return pa.FixedSizeListArray.from_arrays(pa.array(total), dim).cast(pa.list_(pa.int64()))
    return run


def hash_embed(df: DataFrame, text_col: str, keys: list[str], dim: int = 64, out: str = "embedding") -> DataFrame:
    """Feature-hashing embedding per key; rows that share their keys are embedded together."""
    low = F.lower(F.replace(F.col(text_col), F.lit("\n"), F.lit(" ")))
    counts = df.select(*keys, F.arrow_udf(_signed_counts(dim), "array<bigint>")(low).alias("_c"))
    # one sum per dimension over rows, not tokens: a single, partially aggregated exchange by key
    sums = [F.sum(F.col("_c")[i]).cast("double").alias(f"_{i}") for i in range(dim)]
    v = counts.groupBy(*keys).agg(*sums).select(*keys, F.array(*[F.col(f"_{i}") for i in range(dim)]).alias("_v"))
    norm = F.sqrt(F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x))
    return v.select(*keys, F.when(norm > 0, F.transform("_v", lambda x: x / norm)).otherwise(F.col("_v")).alias(out))


def assert_dim(df: DataFrame, col: str, dim: int) -> DataFrame:
    """Vector schema check: fail the job on a vector of another dimension."""
    return df.withColumn(col, F.when(F.size(col) == dim, F.col(col)).otherwise(
        F.raise_error(F.concat(F.lit(f"vector dimension != {dim}: "), F.size(col).cast("string")))))


def _top_of_block(k: int, metric: str, kinds: tuple):
    """Best ``k`` of one block of vectors for every query of one block of queries, ties by id."""
    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(vectors):
            ids = vectors["id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, vm = ids[order], np.stack(vectors["embedding"].to_numpy()[order]).astype(np.float64)
            if metric == "cosine":
                vm = vm / np.maximum(np.linalg.norm(vm, axis=1, keepdims=True), 1e-300)
            step = max(1, CUBE_CELLS // vm.size)
            for i in range(0, len(queries), step):
                some = queries.iloc[i:i + step]
                qm = np.stack(some["vector"].to_numpy()).astype(np.float64)
                if qm.shape[1] != vm.shape[1]:
                    raise ValueError(f"vector dimension {vm.shape[1]} != query dimension {qm.shape[1]}")
                if metric == "cosine":
                    qm = qm / np.maximum(np.linalg.norm(qm, axis=1, keepdims=True), 1e-300)
                    score = (1.0 + qm @ vm.T) / 2.0
                else:
                    score = 1.0 / (1.0 + ((qm[:, None, :] - vm[None, :, :]) ** 2).sum(axis=2))
                best = np.argsort(-score, axis=1, kind="stable")[:, :k]  # ids ascend, so ties go to the least
                out.append(pd.DataFrame({"query_id": np.repeat(some["query_id"].to_numpy(), best.shape[1]), "id": ids[best.ravel()],
                                         "score": np.take_along_axis(score, best, axis=1).ravel()}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "id": [], "score": []}).astype(dict(zip(("query_id", "id"), kinds)))
    return run


def knn_topk_batch(spark: SparkSession, queries: DataFrame, vectors: DataFrame, k: int = 2,
                   query_id: str = "query_id", query_vec: str = "vector", id_col: str = "id",
                   vec_col: str = "embedding", metric: str = "l2") -> DataFrame:
    """Exact top-k per query: (query_id, rank, id, score), ties broken by id.

    l2 score = 1/(1+d^2); cosine score = (1+cos)/2.  Both sides are cut into blocks of bounded rows; every pair of
    blocks meets in one task, by an equi-join on the two block numbers, and only its best ``k`` a query are
    shuffled on.  Exact search compares all queries with all vectors by definition; nothing is collected.
    """
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("vector"))
    v = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("embedding"))
    nq = -(-q.count() // QUERY_BLOCK) or 1
    nv = max(-(-v.count() // VECTOR_BLOCK), spark.sparkContext.defaultParallelism)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    qb = q.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(nq)).cast("int")).withColumn("vb", every(nv))
    vb = v.withColumn("vb", F.pmod(F.xxhash64("id"), F.lit(nv)).cast("int")).withColumn("qb", every(nq))
    types = [d.schema[c].dataType.simpleString() for d, c in ((q, "query_id"), (v, "id"))]
    kinds = tuple("int64" if t in ("int", "bigint") else object for t in types)
    best = qb.groupBy("qb", "vb").cogroup(vb.groupBy("qb", "vb")).applyInPandas(
        _top_of_block(k, metric, kinds), f"query_id {types[0]}, id {types[1]}, score double")
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc())
    return best.select("query_id", F.row_number().over(w).alias("rank"), "id", "score").where(F.col("rank") <= k)


def knn_topk(spark: SparkSession, query_vector: DataFrame, vectors: DataFrame, k: int = 2, **kw) -> DataFrame:
    """Top-k of a few queries, ``query_vector`` (query_id, vector): they are broadcast, vectors stay where they are read."""
    return exact_topk(query_vector, vectors, k=k, **kw)


def knn_approx(queries: DataFrame, vectors: DataFrame, k: int = 2, probes: int | None = None, rerank: int | None = None,
               query_id: str = "query_id", query_vec: str = "vector", id_col: str = "id", vec_col: str = "embedding",
               path: str | None = None) -> DataFrame:
    """Approximate top-k through a fresh index of ``vectors`` (``folio.operators.vector_index``): (query_id, rank, id, score,
    scanned, compared).  Every query gets ``k`` rows (all vectors, if there are fewer).  Ids are taken as unique on both sides."""
    spark = queries.sparkSession
    path = path or scratch_path(spark, "vector-index")
    model = build_index(vectors, path, k, id_col, vec_col)
    if model is None:
        kinds = [d.schema[c].dataType.simpleString() for d, c in ((queries, query_id), (vectors, id_col))]
        return spark.createDataFrame([], f"query_id {kinds[0]}, rank int, id {kinds[1]}, score double, scanned long, compared long")
    return search_index(queries, path, model, k, probes, rerank, query_id, query_vec)


def vector_entries(spark: SparkSession, docs: DataFrame, order_col: str, vec_col: str, name_col: str,
                   description: str = "a good description") -> DataFrame:
    """Number rows 1..n in ``order_col`` order and build index entries
    (id, _id, name, description, embedding).

    Dense numbering without a single-partition window: store the input (range partitioning reads it twice),
    range-partition and sort, checkpoint (partition ids become stable), count rows per partition (one
    small row per partition), then add each partition's offset to its local
    row number.
    """
    docs = docs.checkpoint(eager=True)
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = docs.repartitionByRange(n_parts, order_col).sortWithinPartitions(order_col) \
        .withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)
    counts = ranged.groupBy("_pid").count()
    offsets = counts.select("_pid", (F.sum("count").over(Window.orderBy("_pid")) - F.col("count")).alias("_off"))
    local = ranged.withColumn("_local", F.row_number().over(Window.partitionBy("_pid").orderBy(order_col)))
    numbered = local.join(F.broadcast(offsets), "_pid").withColumn("id", F.col("_off") + F.col("_local"))
    return numbered.select("id", F.col("id").cast("string").alias("_id"), F.col(name_col).alias("name"),
                           F.lit(description).alias("description"), F.col(vec_col).alias("embedding"))
