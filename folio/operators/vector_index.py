"""Approximate nearest neighbours by inverted lists with product-quantised residuals, and exact search that moves no vectors.

Index: coarse centroids are learned by k-means; every vector is listed under its nearest one (its cell).  What is left of
it after subtracting the centroid is cut into runs of ``SUB_DIM`` components, each written as the number of the nearest of
at most 256 code vectors learned for that run.  A list row is (cell, id, code, embedding); rows are sorted by cell, so that
a search reads the row groups of its cells only, and a cell of any size is spread over many tasks.

Search: a query takes its ``probes`` nearest cells (and more until they hold enough vectors for ``k`` results).  Tasks estimate
distances to the vectors listed there from their codes alone, and each sends on its best ``rerank`` a query.  The best of
all are compared exactly.  Queries go to the tasks as broadcasts of at most ``QUERY_BYTES``, block by block;
vectors and codes never leave the task that reads them.

The model is fitted on a bounded sample (``SAMPLE_ROWS`` rows, at most ``SAMPLE_BYTES``), chosen by id hash; every row
is listed.  The sample also gives the defaults of ``probes`` and ``rerank``: held-out rows and random directions are
searched in it, and both are as large as ``TARGET`` of their true neighbours need.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folio.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_ROWS, SAMPLE_BYTES = 1 << 14, 32 << 20
MOST_CELLS = 4096
SUB_DIM = 2
CODES = 256
ROUNDS = 8
TARGET = 0.97  # share of the sample's true neighbours that probes and rerank must reach
TRIALS = 128  # searches of each kind in the sample
QUERY_BYTES = 4 << 20  # of a broadcast block of queries
LEAST_SHARE = 10  # by default at most one in so many vectors is compared exactly, unless k needs more,
MOST_RERANK = 1024  # and at most so many
NEAR_ROWS = 1 << 20  # (query, id) pairs of a block of queries that go through the driver at once


@dataclass
class Model:
    centroids: np.ndarray  # cells x dim
    books: list[np.ndarray]  # for each run of components, codes x width
    sizes: np.ndarray  # vectors listed in each cell
    probes: int
    rerank: int

    @property
    def dim(self) -> int:
        return self.centroids.shape[1]

    def runs(self) -> list[slice]:
        return [slice(a, min(a + SUB_DIM, self.dim)) for a in range(0, self.dim, SUB_DIM)]


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``x`` and ``y``; small negative values of rounding become 0."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)[None, :], 0)


def _nearest(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.concatenate([_distances(x[a:a + 4096], y).argmin(1) for a in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = ROUNDS) -> np.ndarray:
    """At most ``k`` centroids by Lloyd's rounds from distinct rows; a centroid left empty goes to the row farthest from its own."""
    own = np.unique(x, axis=0)
    if len(own) <= k:
        return own
    c = own[rng.choice(len(own), k, replace=False)]
    for _ in range(rounds):
        near = _nearest(x, c)
        count = np.bincount(near, minlength=k)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = sums / np.maximum(count, 1)[:, None]
        empty = np.flatnonzero(count == 0)
        if len(empty):
            far = ((x - c[near]) ** 2).sum(1)
            c[empty] = x[np.argsort(-far)[:len(empty)]]
    return c


def _codes(model: Model, residual: np.ndarray) -> np.ndarray:
    return np.stack([_nearest(residual[:, r], b) for r, b in zip(model.runs(), model.books)], 1).astype(np.uint8)


def _decoded(model: Model, codes: np.ndarray) -> np.ndarray:
    """The residuals that codes stand for."""
    return np.concatenate([b[codes[:, i]] for i, b in enumerate(model.books)], 1)


def fit(sample: np.ndarray, rows: int, k: int = 2, seed: int = 7) -> Model:
    """Model for ``rows`` vectors from a sample of them; ``sizes`` are set when the rows are listed."""
    rng = np.random.default_rng(seed)
    cells = int(min(MOST_CELLS, max(1, round(rows ** 0.5)), max(1, len(sample) // 16)))
    model = Model(kmeans(sample, cells, rng), [], np.zeros(0, np.int64), 1, k)
    near = _nearest(sample, model.centroids)
    residual = sample - model.centroids[near]
    model.books = [kmeans(residual[:, r], CODES, rng) for r in model.runs()]
    codes = _codes(model, residual)
    decoded = model.centroids[near] + _decoded(model, codes)

    own = rng.choice(len(sample), min(TRIALS, len(sample)), replace=False)
    away = rng.normal(size=(TRIALS, sample.shape[1]))
    away *= np.sqrt((sample ** 2).sum(1).mean() / np.maximum((away ** 2).sum(1), 1e-300))[:, None]
    cell_ranks, code_ranks = [], []
    for q, itself in [*((sample[i], i) for i in own), *((q, -1) for q in away)]:
        d = _distances(q[None], sample)[0]
        if itself >= 0:
            d[itself] = np.inf
        true = np.argsort(d, kind="stable")[:min(k, len(sample) - 1)]
        to_cells = _distances(q[None], model.centroids)[0]
        order = np.argsort(np.argsort(to_cells, kind="stable"))
        cell_ranks += order[near[true]].tolist()
        guess = _distances(q[None], decoded)[0]  # what the codes say
        if itself >= 0:
            guess[itself] = np.inf
        code_ranks += [int((guess < guess[t]).sum()) for t in true]
    if cell_ranks:
        model.probes = int(np.quantile(cell_ranks, TARGET)) + 1
        depth = (np.quantile(code_ranks, TARGET) + 1) * max(1.0, rows / len(sample))
        model.rerank = int(max(k, min(max(4 * k, np.ceil(depth)), rows // LEAST_SHARE, MOST_RERANK)))
    return model


def _matrix(column, dim: int | None = None) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if dim is not None and len(flat) != dim * len(column):
        raise ValueError(f"vector dimension {len(flat) / max(len(column), 1):g} != {dim}")
    return flat.reshape(len(column), -1)


def _list_rows(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for b in batches:
            x = _matrix(b.column(1), m.dim)
            cell = _nearest(x, m.centroids)
            codes = _codes(m, x - m.centroids[cell])
            data = pa.py_buffer(np.ascontiguousarray(codes))
            offsets = pa.py_buffer(np.arange(len(x) + 1, dtype=np.int32) * codes.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.astype(np.int32)), b.column(0), pa.Array.from_buffers(pa.binary(), len(x), [None, offsets, data]), b.column(1)],
                names=["cell", "id", "code", "embedding"])
    return run


def build_index(vectors: DataFrame, path: str, k: int = 2, id_col: str = "id", vec_col: str = "embedding", seed: int = 7) -> Model | None:
    """Fit the model, list every vector under ``path`` and return the model (None for an empty table)."""
    spark = vectors.sparkSession
    v = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<float>").alias("embedding"))
    size = v.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("embedding")).alias("dim")).first()
    if not size.n:
        return None
    most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (4 * max(1, size.dim))))
    share = int(min(1.0, 1.1 * most / size.n) * (1 << 30))
    sample = v.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) <= share).select("embedding").limit(most).toArrow()
    model = fit(_matrix(sample.column(0), size.dim), size.n, k, seed)
    kind = v.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (v.mapInArrow(_list_rows(shared), f"cell int, id {kind}, code binary, embedding array<float>")
     .repartitionByRange(parts, "cell", F.xxhash64("id")).sortWithinPartitions("cell").write.parquet(f"{path}/lists"))
    counts = spark.read.parquet(f"{path}/lists").groupBy("cell").count().collect()  # a row a cell
    model.sizes = np.zeros(len(model.centroids), np.int64)
    for r in counts:
        model.sizes[r["cell"]] = r["count"]
    row = [(model.centroids.tobytes(), [b.tobytes() for b in model.books], model.sizes.tobytes(), len(model.centroids), model.probes, model.rerank)]
    (spark.createDataFrame(row, "centroids binary, books array<binary>, sizes binary, cells int, probes int, rerank int")
     .coalesce(1).write.parquet(f"{path}/model"))
    return model


def open_index(spark: SparkSession, path: str) -> Model:
    """The model of an index written before."""
    r = spark.read.parquet(f"{path}/model").first()
    centroids = np.frombuffer(r.centroids).reshape(r.cells, -1)
    model = Model(centroids, [], np.frombuffer(r.sizes, np.int64), r.probes, r.rerank)
    model.books = [np.frombuffer(b).reshape(-1, s.stop - s.start) for b, s in zip(r.books, model.runs())]
    return model


def query_blocks(queries: DataFrame, dim: int, most_bytes: int = QUERY_BYTES) -> Iterator[pa.Table]:
    """(query_id, vector) rows in blocks of about ``most_bytes``, by id hash; one block at a time is on the driver."""
    n = queries.count()
    blocks = max(1, -(-n * 8 * max(1, dim) // most_bytes))
    if blocks > 1:
        path = scratch_path(queries.sparkSession, "queries")
        queries.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).write.partitionBy("_block").parquet(path)
        stored = queries.sparkSession.read.parquet(path)
    for b in range(blocks if n else 0):
        own = queries if blocks == 1 else stored.where(F.col("_block") == b).select(*queries.columns)
        table = own.toArrow()
        if len(table):
            yield table


def _best(rows: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` least values of each row number, in order of row and value (ties in the order given)."""
    order = np.lexsort((np.arange(len(rows)), values, rows))
    first = np.searchsorted(rows[order], rows[order], "left")
    return order[np.arange(len(order)) - first < k]


def _probed(model: Model, queries: np.ndarray, k: int, probes: int, rerank: int) -> list[np.ndarray]:
    """Cells of each query, nearest first: ``probes`` that hold vectors, and as many as hold ``max(k, rerank)`` vectors."""
    out = []
    for a in range(0, len(queries), 1024):
        order = np.argsort(_distances(queries[a:a + 1024], model.centroids), 1, kind="stable")
        for o in order:
            o = o[model.sizes[o] > 0]
            enough = int(np.searchsorted(np.cumsum(model.sizes[o]), max(k, rerank))) + 1
            out.append(o[:max(probes, enough)])
    return out


def _bytes(column: pa.BinaryArray) -> np.ndarray:
    """Rows of equally long bytes as a matrix."""
    column = column.cast(pa.binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]].reshape(len(column), -1)


def _estimate(shared, keep: int):
    """Best ``keep`` listed vectors a query by estimated distance, over the rows of this task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, queries, asked = shared.value
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

        def cut():
            rows, values = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            ids = pa.concat_arrays([h[2] for h in held])
            at = _best(rows, values, keep)
            held[:] = [(rows[at], values[at], ids.take(pa.array(at)))]

        for b in batches:
            cells, ids = b.column(0).to_numpy(), b.column(1)
            codes = _bytes(b.column(2))
            for c in np.unique(cells):
                at = np.flatnonzero(cells == c)
                own = model.centroids[c] + _decoded(model, codes[at])
                mine = np.array(asked.get(int(c), ()), np.int64)
                step = max(1, (1 << 20) // len(at))
                for a in range(0, len(mine), step):
                    some = mine[a:a + step]
                    guess = _distances(queries[some], own)
                    top = (np.argpartition(guess, keep - 1, 1)[:, :keep] if len(at) > keep
                           else np.broadcast_to(np.arange(len(at)), guess.shape))
                    held.append((np.repeat(some, top.shape[1]), np.take_along_axis(guess, top, 1).ravel(), ids.take(pa.array(at[top.ravel()]))))
            if sum(len(h[0]) for h in held) > max(1 << 18, 2 * keep * len(queries)):
                cut()
        if held:
            cut()
            yield pa.RecordBatch.from_arrays([pa.array(held[0][0]), held[0][2], pa.array(held[0][1].astype(np.float64))],
                                             names=["q", "id", "guess"])
    return run


def _compare(shared):
    """Exact scores of the wanted (query, id) pairs among the vectors of this task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, wanted, owners = shared.value
        for b in batches:
            found = pa.compute.index_in(b.column(0), value_set=wanted)
            at = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
            if not len(at):
                continue
            x = _matrix(b.column(1).take(pa.array(at)))
            who = [owners[k] for k in found.drop_null().to_numpy()]
            rows = np.concatenate(who)
            place = np.repeat(np.arange(len(at)), [len(w) for w in who])
            d2 = ((queries[rows] - x[place]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([pa.array(rows), b.column(0).take(pa.array(at[place])), pa.array(1.0 / (1.0 + d2))],
                                             names=["q", "id", "score"])
    return run


def search_index(queries: DataFrame, path: str, model: Model, k: int = 2, probes: int | None = None, rerank: int | None = None,
                 query_id: str = "query_id", query_vec: str = "vector", most_bytes: int = QUERY_BYTES) -> DataFrame:
    """Approximate top-k of each query: (query_id, rank, id, score, scanned, compared), score = 1/(1+d^2), ties by id.

    ``scanned`` and ``compared`` count the vectors whose codes and whose components were looked at.  Every query gets ``k``
    rows, or all vectors if there are fewer.  Query ids are taken as unique."""
    spark = queries.sparkSession
    probes, rerank = probes or model.probes, max(k, rerank or model.rerank)
    lists = spark.read.parquet(f"{path}/lists")
    kind = lists.schema["id"].dataType.simpleString()
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).cast("array<double>").alias("vector"))
    qkind = q.schema["query_id"].dataType.simpleString()
    by_rank = Window.partitionBy("q").orderBy("guess", "id")
    parts = []
    for table in query_blocks(q, model.dim, min(most_bytes, max(1, NEAR_ROWS // rerank) * 8 * model.dim)):
        own = _matrix(table["vector"], model.dim)
        cells = _probed(model, own, k, probes, rerank)
        asked: dict[int, list[int]] = {}
        for i, cs in enumerate(cells):
            for c in cs:
                asked.setdefault(int(c), []).append(i)
        shared = spark.sparkContext.broadcast((model, own, asked))
        here = lists.where(F.col("cell").isin(sorted(asked)))
        near = (here.select("cell", "id", "code").mapInArrow(_estimate(shared, rerank), f"q long, id {kind}, guess double")
                .withColumn("r", F.row_number().over(by_rank)).where(F.col("r") <= rerank).select("q", "id").toArrow())  # rerank a query
        ids = near["id"].combine_chunks().dictionary_encode()
        order = np.argsort(ids.indices.to_numpy(), kind="stable")
        rows = near["q"].to_numpy()
        owners = np.split(rows[order], np.flatnonzero(np.diff(ids.indices.to_numpy()[order])) + 1)
        wanted = spark.sparkContext.broadcast((own, ids.dictionary, owners))
        scored = here.select("id", "embedding").mapInArrow(_compare(wanted), f"q long, id {kind}, score double")
        w = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc())
        top = scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        names = pa.table({"q": pa.array(range(len(own)), pa.int64()), "query_id": table["query_id"],
                          "scanned": pa.array([int(model.sizes[c].sum()) for c in cells], pa.int64()),
                          "compared": pa.array(np.bincount(rows, minlength=len(own)).astype(np.int64))})
        known = spark.createDataFrame(names.to_pandas(), f"q long, query_id {qkind}, scanned long, compared long")
        parts.append(top.join(known, "q").select("query_id", "rank", "id", "score", "scanned", "compared"))
    if not parts:
        return spark.createDataFrame([], f"query_id {qkind}, rank int, id {kind}, score double, scanned long, compared long")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _top_of_task(shared, k: int, metric: str):
    """Best ``k`` vectors of this task for every query, ties by id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = shared.value
        unit = queries / np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-300) if metric == "cosine" else queries
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []

        def cut():
            rows, values = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            ids = pa.concat_arrays([h[2] for h in held])
            places = np.empty(len(ids), np.int64)
            places[pa.compute.sort_indices(ids).to_numpy()] = np.arange(len(ids))
            order = np.lexsort((places, -values, rows))
            keep = order[np.arange(len(order)) - np.searchsorted(rows[order], rows[order], "left") < k]
            held[:] = [(rows[keep], values[keep], ids.take(pa.array(keep)))]

        for b in batches:
            x = _matrix(b.column(1), queries.shape[1])
            if metric == "cosine":
                x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
            step = max(1, (1 << 20) // max(1, len(x)))
            for a in range(0, len(queries), step):
                some = unit[a:a + step]
                if metric == "cosine":
                    score = (1.0 + some @ x.T) / 2.0
                else:
                    score = 1.0 / (1.0 + np.stack([((q - x) ** 2).sum(1) for q in some]))
                kth = np.partition(score, score.shape[1] - k, 1)[:, -k][:, None] if score.shape[1] > k else -np.inf
                r, c = np.nonzero(score >= kth)  # all ties of the k-th: ids decide below
                held.append((r + a, score[r, c], b.column(0).take(pa.array(c))))
            if sum(len(h[0]) for h in held) > max(1 << 18, 2 * k * len(queries)):
                cut()
        if held:
            cut()
            yield pa.RecordBatch.from_arrays([pa.array(held[0][0]), held[0][2], pa.array(held[0][1])], names=["q", "id", "score"])
    return run


def exact_topk(queries: DataFrame, vectors: DataFrame, k: int = 2, query_id: str = "query_id", query_vec: str = "vector",
               id_col: str = "id", vec_col: str = "embedding", metric: str = "l2", most_bytes: int = QUERY_BYTES) -> DataFrame:
    """Exact top-k (query_id, rank, id, score) with queries broadcast in bounded blocks: a task sends on ``k`` rows a query at
    most, and no vector leaves the task that reads it."""
    spark = vectors.sparkSession
    v = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("embedding"))
    q = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).cast("array<double>").alias("vector"))
    kind, qkind = (d.schema[c].dataType.simpleString() for d, c in ((v, "id"), (q, "query_id")))
    width = q.agg(F.max(F.size("vector"))).first()[0] or 1
    w = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc())
    out = None
    for table in query_blocks(q, width, most_bytes):
        shared = spark.sparkContext.broadcast(_matrix(table["vector"], width))
        names = pa.table({"q": pa.array(range(len(table)), pa.int64()), "query_id": table["query_id"]})
        known = spark.createDataFrame(names.to_pandas(), f"q long, query_id {qkind}")
        top = (v.mapInArrow(_top_of_task(shared, k, metric), f"q long, id {kind}, score double")
               .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
               .join(known, "q").select("query_id", "rank", "id", "score"))
        out = top if out is None else out.unionByName(top)
    return out if out is not None else spark.createDataFrame([], f"query_id {qkind}, rank int, id {kind}, score double")
