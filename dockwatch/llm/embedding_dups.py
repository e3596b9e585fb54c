"""Operator 4: near duplicates of embeddings by a forest of random-projection trees."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.shared import Scratch, column, components, deal_tiles, list_values, local_roots, numbers, tile_mask
from dockwatch.llm.topk import finite_vector

#: Quantiles looked at for a split; a split takes the one with the fewest rows in its overlap.
QUANTILES = 21
#: Split tables up to this many rows (40 bytes each) are broadcast, larger ones joined by shuffle.
BROADCAST_SPLITS = 100_000


def _directions(dim: int, trees: int, levels: int, seed: int) -> np.ndarray:
    r = np.random.default_rng([seed, dim]).standard_normal((dim, trees * levels))
    return r / np.linalg.norm(r, axis=0)


def _unit(arr: pa.Array, dim: int) -> np.ndarray:
    x = list_values(arr)[0].astype(np.float64).reshape(-1, dim)
    with np.errstate(over="ignore"):
        x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _project(trees: int, levels: int, seed: int):
    """(rep, tree, p): a row's projections on the directions of each level of each tree."""

    def run(batches):
        for b in batches:
            size = np.diff(b.column("embedding").offsets.to_numpy())
            for dim in np.unique(size):
                sub = b.filter(pa.array(size == dim))
                p = (_unit(sub.column("embedding"), int(dim)) @ _directions(int(dim), trees, levels, seed))
                flat = pa.array(p.astype(np.float32).reshape(-1), pa.float32())
                n = sub.num_rows * trees
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.repeat(sub.column("rep").to_numpy(), trees)),
                    pa.array(np.tile(np.arange(trees) + int(dim) * trees, sub.num_rows), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * levels, pa.int32()), flat),
                ], names=["rep", "tree", "p"])

    return run


def forest_leaves(vecs: DataFrame, threshold: float, trees: int, leaf_rows: int, seed: int,
                  scratch: Scratch) -> DataFrame:
    """(rep, leaf): the leaves each vector falls into.

    Level by level every node of over ``leaf_rows`` rows is split at a quantile of its projections
    on a random direction. Rows within ``margin`` of the split go to both sides
    (spill). The margin is half the deviation that the projections of a pair just at the threshold
    differ by, so a split rarely parts such a pair. Of the node's inner quantiles the split takes
    the one with the fewest rows in its margin, which keeps a crowd of near copies on one side;
    a node with most of its rows in every margin is one crowd and stays whole (its leaf is compared in tiles).
    """
    n, dim = vecs.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    if not n:
        return vecs.select("rep", F.lit(0).cast("long").alias("leaf"))
    levels = 2 * max(0, math.ceil(math.log2(n / leaf_rows))) + 4
    margin = 0.5 * math.sqrt(2 - 2 * threshold) / math.sqrt(dim)
    at = scratch.table(vecs.select("rep", "embedding").mapInArrow(
        _project(trees, levels, seed), "rep long, tree long, p array<float>").withColumn("node", F.lit(1).cast("long")))
    done = []
    share = [i / (QUANTILES - 1) for i in range(QUANTILES)]
    for level in range(levels):
        p = F.get("p", F.lit(level)).cast("double")
        node = at.groupBy("tree", "node").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(p, share, 400).alias("q"))
        near = lambda k: F.size(F.filter("q", lambda x: F.abs(x - F.get("q", k)) <= margin))
        cand = F.transform(F.sequence(F.lit(QUANTILES // 5), F.lit(QUANTILES - 1 - QUANTILES // 5)),
                           lambda k: F.struct(near(k).alias("mass"), F.abs(k - QUANTILES // 2).alias("off"),
                                              F.get("q", k).alias("cut")))
        node = node.withColumn("best", F.array_min(cand)).select(
            "tree", "node", F.when((F.col("n") > leaf_rows) & (F.col("best.mass") <= QUANTILES // 2), F.col("best.cut")).alias("cut"))
        node = scratch.table(node)
        total, open_ = node.agg(F.count(F.lit(1)), F.count("cut")).first()
        if not open_:
            break
        marked = at.join(F.broadcast(node) if total <= BROADCAST_SPLITS else node, ["tree", "node"])
        done.append(marked.where("cut is null").select("rep", "tree", "node"))
        side = F.explode(F.filter(F.array(F.when(p <= F.col("cut") + margin, 0), F.when(p >= F.col("cut") - margin, 1)),
                                  lambda s: s.isNotNull()))
        at = scratch.table(marked.where("cut is not null").withColumn("side", side).select(
            "rep", "tree", "p", (F.col("node") * 2 + F.col("side")).alias("node")))
    out = at.select("rep", "tree", "node")
    for x in done:
        out = out.union(x)
    # tree above node: leaves of an earlier tree have smaller numbers
    return out.select("rep", (F.shiftleft(F.col("tree"), 42) + F.col("node")).alias("leaf"))


def _compare(threshold: float):
    def run(t: pa.Table) -> pa.Table:
        dim = len(column(t, "embedding")[0])
        x = _unit(column(t, "embedding"), dim)
        rep, weight, leaf = numbers(t, "rep"), numbers(t, "n"), int(column(t, "leaf")[0].as_py())
        lo, hi = int(column(t, "lo")[0].as_py()), int(column(t, "hi")[0].as_py())
        linked = (x @ x.T >= threshold) & tile_mask(numbers(t, "blk"), lo, hi)
        linked |= linked.T
        rows = np.flatnonzero(linked.any(axis=1))
        linked = linked[np.ix_(rows, rows)]
        root = rep[rows][local_roots(linked)] if len(rows) else rep[:0]
        # a pair counts in the first leaf that holds both; here only those that share no earlier leaf
        val, off = list_values(column(t, "leaves"))
        owner = np.repeat(np.arange(t.num_rows), np.diff(off))
        place = np.full(t.num_rows, -1)
        place[rows] = np.arange(len(rows))
        use = (val < leaf) & (place[owner] >= 0)
        if use.any():
            kinds, col = np.unique(val[use], return_inverse=True)
            line = place[owner[use]]
            for a in range(0, len(kinds), 2048):
                part = (col >= a) & (col < a + 2048)
                has = np.zeros((len(rows), min(2048, len(kinds) - a)), np.float32)
                has[line[part], col[part] - a] = 1
                linked &= (has @ has.T) == 0
        links = linked @ weight[rows].astype(np.int64)
        return pa.table({"rep": pa.array(rep[rows], pa.int64()), "links": pa.array(links, pa.int64()),
                         "root": pa.array(root, pa.int64())})

    return run


def near_duplicates(rows: DataFrame, threshold: float = 0.95, trees: int = 6, leaf_rows: int = 512,
                    block: int = 1024, seed: int = 42) -> DataFrame:
    """Links between vectors whose cosine (in double precision) is at least ``threshold``.

    ``rows``: vec_id, embedding. Returns one row per vec_id: n_links (other vectors linked
    directly), component_id (smallest vec_id reachable by links), kept (vec_id = component_id).

    Equal vectors are one class with a weight. A forest of random-projection trees with
    spill overlap proposes pairs, each leaf compares its vectors by one matrix product (a crowded leaf
    in tiles) and counts a pair only in the first leaf that holds both. No pair is ever a row: leaves return counts and
    a spanning star, whose union gives the components.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing and
    are their own component. Rows repeating a vec_id are one vector (the smallest); a null vec_id is one
    more vector without links. Vectors of different lengths never link.
    """
    scratch = Scratch(rows.sparkSession, "embdup")
    ok = finite_vector("embedding") & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull()
    base = rows.groupBy("vec_id").agg(F.min(F.when(ok, F.col("embedding"))).alias("embedding"))
    base = scratch.table(base)
    vecs = scratch.table(base.where("embedding is not null").groupBy("embedding").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    leaves = scratch.table(forest_leaves(vecs, threshold, trees, leaf_rows, seed, scratch))
    held = leaves.groupBy("rep").agg(F.collect_list("leaf").alias("leaves"))  # trees x spill entries a row
    spread = vecs.join(held, "rep").select("*", F.explode("leaves").alias("leaf"))
    tiles = deal_tiles(spread, "leaf", "rep", block)
    found = scratch.table(tiles.groupBy("leaf", "lo", "hi").applyInArrow(
        _compare(threshold), "rep long, links long, root long"))
    roots = components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")), scratch)
    roots = roots.select(F.col("node").alias("rep"), "root")
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    per = vecs.join(counts, "rep", "left").join(roots, "rep", "left").select(
        "embedding", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("root", "rep").alias("component_id"))
    out = base.join(per, "embedding", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
