"""Operator 2: exact top-k by inner product, as tiled matrix products with tree-merged lists."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockwatch.llm.shared import Scratch, column, list_values, numbers

#: Largest integers a double product still adds up exactly.
EXACT = 2.0 ** 53


def finite_vector(vec: str) -> Column:
    """True for a vector that is not null or empty and holds no null, NaN or infinity."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.col(vec).isNotNull() & (F.size(vec) > 0) & ~F.coalesce(bad, F.lit(True))


def quantised(vec: str, scale: int) -> Column:
    return F.transform(F.col(vec), lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long"))


def _int_matrix(t: pa.Table, name: str, dim: int) -> np.ndarray:
    return list_values(column(t, name))[0].reshape(-1, dim)


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products: by doubles where every partial sum stays below 2^53, by integers where it stays below 2^63, else by
    integers of any size. A score that is no long is an error, never a wrapped number."""
    # as doubles first: the absolute value of the smallest long is no long
    top = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(c.astype(np.float64)).max(initial=0)) * q.shape[1]
    if top < EXACT:
        return (q.astype(np.float64) @ c.T.astype(np.float64)).astype(np.int64)
    if top < 2.0 ** 62:
        return q @ c.T
    wide = q.astype(object) @ c.T.astype(object)
    limit = np.iinfo(np.int64)
    if wide.size and (wide.min() < limit.min or wide.max() > limit.max):
        raise OverflowError("an inner product is beyond 64 bits")
    return wide.astype(np.int64)


def _tile(k: int, step: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            dim = len(column(left, "q")[0])
            qid, cid = numbers(left, "vec_id"), numbers(right, "cand_id")
            order = np.argsort(cid, kind="stable")  # columns by id: the first of equal scores wins
            cid, c, q = cid[order], _int_matrix(right, "cand", dim)[order], _int_matrix(left, "q", dim)
            for a in range(0, len(qid), step):
                s = _products(q[a:a + step], c)
                for i, row in enumerate(s):
                    keep = cid != qid[a + i]
                    if keep.sum() > k:
                        cut = np.partition(row[keep], -k)[-k]  # the k-th best score, ties included
                        keep &= row >= cut
                    at = np.flatnonzero(keep)
                    at = at[np.argsort(-row[at], kind="stable")][:k]
                    out.append((np.full(len(at), qid[a + i]), cid[at], row[at]))
        cols = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table([pa.array(x, pa.int64()) for x in cols], names=["query_id", "vec_id", "score"])

    return run


def exact_top_k(rows: DataFrame, is_query: Column, k: int = 20, scale: int = 64, query_tile: int = 1024,
                shard_rows: int = 8192, fan_in: int = 16) -> DataFrame:
    """The ``k`` rows of the highest integer inner product with each query row.

    ``rows``: vec_id, embedding. Components become floor(scale * x). Returns query_id, rank
    (from 1; ties to the smaller vec_id), vec_id, score. A query is no candidate of its own.

    Queries are dealt into tiles, all rows into shards; each tile meets each shard in
    one task that multiplies two small matrices and keeps k rows per query. The
    lists are merged as a tree of ``fan_in``, so no task sees more than ``fan_in * k``
    rows of a query. Work is queries x rows by definition; the rows
    moved are queries x shards + rows x tiles.

    Vectors that are null, empty or hold null or non-finite components, and rows of a null
    vec_id, take no part. Rows repeating a vec_id count once (the smallest vector). Vectors of other lengths
    than the query's are not compared with it. Fewer candidates than k: all of them. No queries: no rows. A score beyond 64 bits
    fails the job.
    """
    scratch = Scratch(rows.sparkSession, "topk")
    good = rows.where(finite_vector("embedding") & F.col("vec_id").isNotNull())
    vecs = scratch.table(good.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
                         .select("vec_id", quantised("embedding", scale).alias("q"), is_query.alias("is_query")))
    n, nq = vecs.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    shards, tiles = max(1, -(-n // shard_rows)), max(1, -(-nq // query_tile))
    deal = lambda name, m: F.pmod(F.xxhash64(F.lit(name), "vec_id"), F.lit(m))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)).cast("array<long>"))
    dim = F.size("q").alias("dim")
    left = vecs.where("is_query").select("vec_id", "q", dim, deal("tile", tiles).alias("tile"), every(shards).alias("shard"))
    # own names: the two sides of a cogroup must not share columns of one source
    right = vecs.select(F.col("vec_id").alias("cand_id"), F.col("q").alias("cand"), dim, deal("shard", shards).alias("shard"), every(tiles).alias("tile"))
    key = ["dim", "tile", "shard"]
    part = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        _tile(k, 256), "query_id long, vec_id long, score long")
    best = [F.desc("score"), "vec_id"]
    while shards > fan_in:
        shards = -(-shards // fan_in)
        node = F.pmod(F.xxhash64("vec_id"), F.lit(shards))
        w = Window.partitionBy("query_id", "node").orderBy(*best)
        part = (part.withColumn("node", node).withColumn("r", F.row_number().over(w))
                .where(F.col("r") <= k).drop("r", "node"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*best))
    return part.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
