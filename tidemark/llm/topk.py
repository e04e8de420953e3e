"""Exact top-k search by integer inner product: a KD-tree per shard, best-first, the k-th score handed on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

#: Vectors in a shard and queries in a block: what one task holds at a time.
SHARD_ROWS = 16_384
BLOCK_ROWS = 1024
LEAF_ROWS = 32
#: Leaves that a query scores before its k-th score is updated.
STRIDE = 4
LEAST = -(2**63)


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, vector) with each component x as floor(scale * x). Vectors that are NULL, hold a NULL, NaN or
    infinite component or have no id are left out; of rows that repeat an id the smallest vector counts."""
    wide = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    bad = F.exists("wide", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), wide.alias("wide"))
        .filter(F.col("vec_id").isNotNull() & F.col("wide").isNotNull()).filter(~bad)
        .groupBy("vec_id").agg(F.min("wide").alias("wide"))
        .select("vec_id", F.transform("wide", lambda x: F.floor(x * F.lit(float(scale)))).alias("vector"))
    )


def build(points: np.ndarray, leaf: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A KD-tree in heap order: median splits on the widest dimension down to leaves of at most ``leaf`` points.
    Gives the points' order, the first point of each leaf, and the tight boxes of all nodes."""
    depth = max(0, int(np.ceil(np.log2(max(1, len(points)) / leaf))))
    nodes = 2 ** (depth + 1) - 1
    low, high = np.zeros((nodes, points.shape[1])), np.zeros((nodes, points.shape[1]))
    spans = [np.arange(len(points))]
    at = 0
    for level in range(depth + 1):
        below = []
        for own in spans:
            box = points[own]
            if len(own):
                low[at], high[at] = box.min(0), box.max(0)
            if level < depth:
                middle = len(own) // 2
                wide = int((high[at] - low[at]).argmax()) if points.shape[1] else 0
                order = np.argpartition(box[:, wide], middle) if len(own) > 1 and points.shape[1] else np.arange(len(own))
                below += [own[order[:middle]], own[order[middle:]]]
            at += 1
        spans = below or spans
    starts = np.cumsum([0, *map(len, spans)])
    return np.concatenate(spans), starts, low, high


def search(queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int, leaf: int = LEAF_ROWS):
    """The best k points of one shard for each query, none scoring under the query's ``floor`` (the k-th score known so
    far). Boxes bound the inner product; subtrees whose bound is under the floor are never opened, and leaves are
    visited best bound first until the bound falls under the k-th score. Ties go to the smaller id, so a leaf whose
    bound equals the k-th score is still opened."""
    order, starts, low, high = build(points, leaf)
    points, ids = points[order], ids[order]
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    bound = lambda q, n: np.einsum("ij,ij->i", up[q], high[n]) + np.einsum("ij,ij->i", down[q], low[n])
    q, n, inner = np.arange(len(queries)), np.zeros(len(queries), np.int64), len(low) // 2
    b = bound(q, n)
    while True:
        open_ = b >= floor[q]
        q, n, b = q[open_], n[open_], b[open_]
        if not len(n) or n[0] >= inner:
            break
        q, n = np.repeat(q, 2), np.stack([2 * n + 1, 2 * n + 2], 1).ravel()
        b = np.concatenate([bound(q[i:i + 65536], n[i:i + 65536]) for i in range(0, len(q), 65536)])
    best = np.full((len(queries), k), -np.inf)
    who = np.full((len(queries), k), np.iinfo(np.int64).max)
    by = np.lexsort((-b, q))
    q, n, b = q[by], n[by] - inner, b[by]
    at = np.searchsorted(q, np.arange(len(queries)))
    until = np.searchsorted(q, np.arange(len(queries)), "right")
    lanes = np.arange(int(np.diff(starts).max(initial=0)))
    while True:
        going = at < until
        going[going] = b[at[going]] >= np.maximum(best[going, -1], floor[going])
        live = np.flatnonzero(going)
        if not len(live):
            return best, who
        steps = at[live][:, None] + np.arange(STRIDE)
        leaves = n[np.minimum(steps, len(n) - 1)]
        rows = starts[leaves][:, :, None] + lanes
        real = (steps < until[live][:, None])[:, :, None] & (rows < starts[leaves + 1][:, :, None])
        rows, real = np.where(real, rows, 0).reshape(len(live), -1), real.reshape(len(live), -1)
        got = np.einsum("qrd,qd->qr", points[rows], queries[live])
        own = ids[rows]
        ok = real & (own != query_ids[live][:, None]) & (got >= floor[live][:, None])
        scores = np.concatenate([best[live], np.where(ok, got, -np.inf)], 1)
        named = np.concatenate([who[live], np.where(ok, own, np.iinfo(np.int64).max)], 1)
        top = np.lexsort((named, -scores), axis=1)[:, :k]
        best[live], who[live] = np.take_along_axis(scores, top, 1), np.take_along_axis(named, top, 1)
        at[live] += STRIDE


def plain(queries: np.ndarray, query_ids: np.ndarray, floor: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int):
    """For components too large for exact doubles: every score in whole numbers of any size, then held to 64 bits."""
    best = np.full((len(queries), k), None, object)
    who = np.full((len(queries), k), np.iinfo(np.int64).max)
    for i, q in enumerate(queries):
        scores = [min(max(int(s), LEAST), -LEAST - 1) for s in points.dot(q)] if len(points) else []
        found = sorted(((-s, int(v)) for s, v in zip(scores, ids) if v != query_ids[i] and s >= floor[i]))[:k]
        for j, (s, v) in enumerate(found):
            best[i, j], who[i, j] = -s, v
    return best, who


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(flat), -1 if len(flat) and len(flat[0]) else 0)


def found_in(left: pa.Table, right: pa.Table, k: int) -> Iterator[pa.RecordBatch]:
    """Answers of one shard (``right``) to its queries (``left``), a block at a time."""
    if not left.num_rows or not right.num_rows:
        return
    points, ids = matrix(right.column("vector")), right.column("vec_id").to_numpy()
    for at in range(0, left.num_rows, BLOCK_ROWS):
        block = left.slice(at, BLOCK_ROWS)
        queries, names = matrix(block.column("asked")), block.column("query_id").to_numpy()
        floor = block.column("floor").to_numpy()
        width = float(np.abs(points).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, points.shape[1])
        if width < 2**52:
            best, who = search(queries.astype(float), names, floor.astype(float), points.astype(float), ids, k)
            real = best > -np.inf
        else:
            best, who = plain(queries.astype(object), names, floor, points.astype(object), ids, k)
            real = best != None  # noqa: E711
        q, _ = np.nonzero(real)
        yield pa.record_batch({"query_id": pa.array(names[q], pa.int64()), "vec_id": pa.array(who[real], pa.int64()),
                               "score": pa.array([int(x) for x in best[real]], pa.int64())})


ANSWER = "query_id long, vec_id long, score long"


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, *, scale: int = 256, id_col: str = "vec_id",
    vector_col: str = "embedding", shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """For each query row the ``k`` other rows with the largest inner product of floor(scale * x), ties to the smaller
    id: (query_id, rank, vec_id, score). ``is_query`` is a condition on the id.

    Vectors are dealt by a hash of the id into shards of about ``shard_rows``, whose number follows the table. Round one
    asks one shard per query, which gives a first k-th score. Round two sends each query with that score to all shards:
    the query set is repeated per shard, so the work is queries x shards by design, but a shard opens only boxes whose
    bound reaches the score. A shard's task holds its vectors and the queries in blocks.

    Vectors that are NULL, hold NULL or non-finite components, or have no id take no part; repeated ids count once (the
    smallest vector); vectors meet only vectors of their own length; empty vectors score 0. Floors stop at the ends of 64
    bits, and so do scores: beyond, vectors tie and the smaller id comes first. Components too large for exact doubles are
    scored in whole numbers, without the tree. Other columns are ignored. Empty input gives no rows.
    """
    held = stage(quantised(vectors, id_col, vector_col, scale).withColumn("width", F.size("vector")), "topk-vectors")
    shards = max(1, -(-held.count() // shard_rows))
    held = held.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    queries = held.withColumnRenamed("vec_id", id_col).filter(is_query).withColumnRenamed(id_col, "query_id")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        out = list(found_in(left, right, k))
        return pa.Table.from_batches(out) if out else pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})

    def ask(asked: DataFrame) -> DataFrame:
        points = held.select("vec_id", "vector", "width", "shard")
        asked = asked.select("query_id", F.col("vector").alias("asked"), F.col("width").alias("w"), F.col("shard").alias("s"), "floor")
        return asked.groupBy("w", "s").cogroup(points.groupBy("width", "shard")).applyInArrow(answer, ANSWER)

    first = stage(ask(queries.select("query_id", "vector", "width", "shard", F.lit(LEAST).alias("floor"))), "topk-first")
    kth = first.groupBy("query_id").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
    known = queries.join(kth, "query_id", "left").withColumn("floor", F.when(F.col("n") >= k, F.col("kth")).otherwise(F.lit(LEAST)))
    others = known.withColumn("home", F.col("shard")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    others = others.filter("shard <> home").select("query_id", "vector", "width", "shard", "floor")
    every = first.unionByName(ask(others)) if shards > 1 else first
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return every.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
