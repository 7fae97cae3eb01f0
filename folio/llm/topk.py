"""Exact top-k search by inner product: a ball tree per shard, searched by branch and bound.

Vectors are dealt by id hash over shards of bounded size.  A task reads a shard's vectors, builds a ball tree
over them and then streams the queries that come after them, ``BLOCK`` at a time.  A node with centre c and radius
r holds no vector whose inner product with q exceeds q.c + |q| r.  Nodes are searched from the root in falling
order of that bound; a node is left out once its bound is below the query's current k-th score.

That score is shared in two ways: each leaf searched raises it for all leaves after it, and a first wave searches
each query in one shard only, so that every other shard starts from the k-th score found there (any k
vectors bound the k-th best of all from below).  Results of shards, at most k a query, are merged by rank.

Memory: one shard and one block of queries.  A query's row goes to every shard: some hundred bytes of
shuffle against the search of ``SHARD_BYTES`` of vectors.  Vectors themselves move once.

Components become floor(1024 x) with x as double.  Scores are exact: float products where every partial sum
is below 2**53, else 64-bit integers; scores that could leave 63 bits raise an error.

Defined cases: vectors that are null, or hold null or non-finite components, and rows without an id take no
part, as query or candidate.  Of two vectors of unlike length the shorter counts as filled up with zeros.
Every row whose id is not the query's is a candidate; repeated rows are candidates each.  Queries repeated
with equal vectors count once; unlike vectors under one query id are ranked together.  Ties go to smaller ids.
An empty table, or a query without candidates, gives no rows.  Other columns are disregarded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SCALE = 1024.0
SHARD_BYTES = 64 << 20  # of a shard's vectors as doubles
SHARD_ROWS = 1 << 12  # smaller tables are dealt over the cores in shards of this many vectors or more
LEAF = 128  # vectors in a leaf at most
BLOCK = 256  # queries searched side by side
OWN_LEAVES = 4  # leaves that every query takes in its own order before the rest are swept
HELD = 1 << 18  # candidates held before they are cut to k a query

OUT = "query_id long, vec_id long, score long"


class BallTree:
    """Nodes in level order; a node covers rows ``begin`` to ``end`` of the reordered vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        nodes, children, at = [(0, len(ids))], [], 0
        while at < len(nodes):
            a, b = nodes[at]
            if b - a > leaf:
                own = order[a:b]
                x = vectors[own]
                middle = (b - a) // 2
                axis = x[:, np.argmax(x.max(0) - x.min(0))]
                order[a:b] = own[np.argpartition(axis, middle)]
                children.append((len(nodes), len(nodes) + 1))
                nodes += [(a, a + middle), (a + middle, b)]
            else:
                children.append((-1, -1))
            at += 1
        self.begin, self.end = (np.array(x, np.int64) for x in zip(*nodes))
        self.children = np.array(children, np.int64)
        self.ids, self.vectors = ids[order], vectors[order]
        self.centre = np.empty((len(nodes), vectors.shape[1]))
        self.radius = np.empty(len(nodes))
        for k, (a, b) in enumerate(nodes):
            x = self.vectors[a:b]
            self.centre[k] = x.mean(0)
            self.radius[k] = np.sqrt(((x - self.centre[k]) ** 2).sum(1).max())
        self.largest = np.sqrt((self.vectors ** 2).sum(1).max())

    def bounds(self, queries: np.ndarray, norms: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Upper bound of the inner product for each query and node, with room for rounding."""
        b = queries @ self.centre[nodes].T + norms[:, None] * self.radius[nodes][None, :]
        return b + 1e-9 * norms[:, None] * self.largest + 1e-6


class _Best:
    """The best k candidates of each query of a block and its k-th score (-inf while there are fewer)."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.k, self.kth = k, floor.astype(np.float64)
        self.top = np.full((n, k), -np.inf)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores``: rows x ids, -inf where the candidate is the query itself."""
        r, c = np.nonzero((scores >= self.kth[rows][:, None]) & (scores > -np.inf))
        if not len(r):
            return
        self.held.append((rows[r], ids[c], scores[r, c]))
        self.size += len(r)
        both = np.concatenate([self.top[rows], scores.astype(np.float64)], 1)
        self.top[rows] = np.partition(both, both.shape[1] - self.k, 1)[:, -self.k:]
        self.kth[rows] = np.maximum(self.kth[rows], self.top[rows].min(1))
        if self.size > HELD:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows, ids, scores = (np.concatenate(x) for x in zip(*self.held))
        order = np.lexsort((ids, -scores, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        first = np.searchsorted(rows, rows, "left")
        keep = np.arange(len(rows)) - first < self.k
        self.held = [(rows[keep], ids[keep], scores[keep])]
        self.size = int(keep.sum())
        return self.held[0]


def search_tree(tree: BallTree, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int):
    """(query row, id, score) of each query's best ``k`` in the tree, without those below its ``floor``."""
    norms = np.sqrt((queries ** 2).sum(1))
    reach = float(norms.max(initial=0)) * float(tree.largest)
    if reach >= 2 ** 62:
        raise ValueError("inner products of these vectors may not fit 64 bits")
    exact = np.float64 if reach < 2 ** 52 else np.int64  # below, every partial sum is an exact double
    held = tree.vectors.astype(exact, copy=False)
    own = queries.astype(exact, copy=False)
    best = _Best(len(ids), k, floor)

    leaf_rows, leaf_nodes, leaf_bounds = [], [], []
    rows, nodes = np.arange(len(ids)), np.zeros(1, np.int64)
    level = [(rows, nodes)] if len(tree.ids) else []
    while level:  # down the tree, all nodes of a level at once; a node's queries are those whose k-th score it may pass
        deeper = []
        for rows, nodes in level:
            b = tree.bounds(queries[rows], norms[rows], nodes)
            open_ = b >= best.kth[rows][:, None]
            for j, node in enumerate(nodes):
                mine = np.flatnonzero(open_[:, j])
                if not len(mine):
                    continue
                if tree.children[node, 0] < 0:
                    leaf_rows.append(rows[mine])
                    leaf_nodes.append(np.full(len(mine), node))
                    leaf_bounds.append(b[mine, j])
                else:
                    deeper.append((rows[mine], tree.children[node]))
        level = deeper
    if not leaf_rows:
        return best.cut()
    rows, nodes, bounds = (np.concatenate(x) for x in (leaf_rows, leaf_nodes, leaf_bounds))

    def visit(at: np.ndarray) -> None:
        """Search the (query, leaf) pairs ``at`` whose bound still reaches the k-th score, leaf by leaf."""
        at = at[bounds[at] >= best.kth[rows[at]]]
        if not len(at):
            return
        heights = np.full(len(tree.begin), -np.inf)
        np.maximum.at(heights, nodes[at], bounds[at])
        at = at[np.lexsort((nodes[at], -heights[nodes[at]]))]
        for part in np.split(at, np.flatnonzero(np.diff(nodes[at])) + 1):
            node = nodes[part[0]]
            r = rows[part]
            r = r[bounds[part] >= best.kth[r]]
            if not len(r):
                continue
            a, b = tree.begin[node], tree.end[node]
            s = own[r] @ held[a:b].T
            itself = ids[r][:, None] == tree.ids[a:b][None, :]
            if exact is np.int64:
                _exact_add(best, r, tree.ids[a:b], s, itself)
            else:
                s[itself] = -np.inf
                best.add(r, tree.ids[a:b], s)

    order = np.lexsort((-bounds, rows))  # each query's leaves, best bound first
    place = np.arange(len(order)) - np.searchsorted(rows[order], rows[order], "left")
    for step in range(OWN_LEAVES):
        visit(order[place == step])
    visit(order[place >= OWN_LEAVES])
    return best.cut()


def _exact_add(best: _Best, rows, ids, scores, itself) -> None:
    """Scores beyond exact doubles: all candidates are held as integers and cut at once; the k-th is rounded down."""
    r, c = np.nonzero(~itself)
    best.held.append((rows[r], ids[c], scores[r, c]))
    found, _, kept = best.cut()
    last = np.flatnonzero(np.diff(found, append=-1))
    full = last[np.searchsorted(found, found[last], "right") - np.searchsorted(found, found[last], "left") == best.k]
    best.kth[found[full]] = np.maximum(best.kth[found[full]], np.nextafter(kept[full].astype(np.float64), -np.inf))


def _integers(column: pa.Array) -> np.ndarray:
    """floor(1024 x) of list rows as a matrix of doubles, shorter rows filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    width = int(sizes.max(initial=0))
    if len(sizes) and (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _wide(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def _stack(parts: list[np.ndarray]) -> np.ndarray:
    width = max(p.shape[1] for p in parts)
    return np.concatenate([_wide(p, width) for p in parts])


def _runs(x: np.ndarray) -> list[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(x)) + 1), len(x)]
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def _search_shards(k: int):
    """Rows sorted by (shard, kind): a shard's vectors (kind 0) come before the queries sent to it (kind 1)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree = None, None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def answer():
            nonlocal tree
            ids, floor = np.concatenate([w[0] for w in waiting]), np.concatenate([w[2] for w in waiting])
            queries = _stack([w[1] for w in waiting])
            waiting.clear()
            if tree is None and held:
                tree = BallTree(np.concatenate([h[0] for h in held]), _stack([h[1] for h in held]))
                held.clear()
            if tree is None:
                return
            width = max(tree.vectors.shape[1], queries.shape[1])
            tree.vectors, tree.centre = _wide(tree.vectors, width), _wide(tree.centre, width)
            for a in range(0, len(ids), BLOCK):
                part = slice(a, a + BLOCK)
                rows, found, scores = search_tree(tree, ids[part], _wide(queries[part], width), floor[part], k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[part][rows]), pa.array(found), pa.array(scores.astype(np.int64))],
                    names=["query_id", "vec_id", "score"])

        for batch in batches:
            shards, kinds, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            floors = batch.column(4).to_numpy(zero_copy_only=False).astype(np.float64)
            vectors = _integers(batch.column(3))
            for a, b in _runs(shards):
                if shards[a] != shard:
                    if waiting:
                        yield from answer()
                    shard, tree = shards[a], None
                    held.clear()
                old = a + int(np.searchsorted(kinds[a:b], 1))
                if old > a:
                    held.append((ids[a:old], vectors[a:old]))
                if b > old:
                    waiting.append((ids[old:b], vectors[old:b], floors[old:b]))
                if sum(len(w[0]) for w in waiting) >= BLOCK:
                    yield from answer()
        if waiting:
            yield from answer()
    return run


def _usable(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return vector.isNotNull() & ok


def _ranked(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def search(queries: DataFrame, vectors: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
           shard_bytes: int = SHARD_BYTES, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Each query's ``k`` best vectors: query_id, rank (from 1), vec_id, score."""
    spark = vectors.sparkSession

    def rows(df: DataFrame) -> DataFrame:
        vector = F.col(f"`{vector_col}`").cast("array<double>")
        return df.select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.alias("v")).where(
            F.col("id").isNotNull() & _usable(F.col("v")))

    size = rows(vectors).agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    shards = max(1, -(-size.n * 8 * max(size.width or 1, 1) // shard_bytes),
                 min(size.n // shard_rows, spark.sparkContext.defaultParallelism))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    base = rows(vectors).select(shard.alias("shard"), F.lit(0).alias("kind"), "id", "v",
                                F.lit(float("-inf")).alias("floor"))
    asked = rows(queries).dropDuplicates()

    def wave(sent: DataFrame) -> DataFrame:
        both = base.unionByName(sent.select("shard", F.lit(1).alias("kind"), "id", "v", "floor"))
        dealt = both.repartition(shards, "shard").sortWithinPartitions("shard", "kind")
        return dealt.mapInArrow(_search_shards(k), OUT)

    first = stored(wave(asked.withColumn("shard", shard).withColumn("floor", F.lit(float("-inf")))), "topk-first")
    if shards == 1:
        return _ranked(first, k).select("query_id", "rank", "vec_id", "score")
    known = (_ranked(first, k).where(F.col("rank") == k)
             .select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("floor")))
    sent = (asked.join(known, "id", "left").fillna(float("-inf"), ["floor"])
            .withColumn("own", shard)
            .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
            .where("shard != own"))
    found = first.unionByName(wave(sent))
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
