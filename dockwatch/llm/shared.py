"""Helpers the operators share: tables, written intermediates, tiles, connected components."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwatch.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written to the folder named by ``spark.checkpoint.dir``.

    A written table cuts the lineage: its rows survive lost executors and are
    not computed again by each reader. ``drop`` frees one that no returned
    frame reads any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self._n = 0

    def table(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/t{self._n}"
        self._n += 1
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark._jvm
        for f in frames:
            p = jvm.org.apache.hadoop.fs.Path(f._scratch_path)
            p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def deal_tiles(rows: DataFrame, key: str, item: str, block: int) -> DataFrame:
    """Deal the rows of each ``key`` into blocks of about ``block`` rows and pair
    the blocks, so that any two rows of a key meet in exactly one tile.

    Adds ``blk`` and the tile ``(lo, hi)``. A key of n rows makes
    about (n / block)^2 / 2 tiles of at most about ``2 * block`` rows, whatever n is.
    Keys with a single row get no tile.
    """
    sizes = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    nb = F.ceil(F.col("_n") / F.lit(block))
    out = rows.join(sizes, key).withColumn("_nb", nb)
    out = out.withColumn("blk", F.pmod(F.xxhash64(F.lit("blk"), item), F.col("_nb")))
    out = out.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_nb") - 1)))
    return out.select("*", F.least("blk", "_o").alias("lo"), F.greatest("blk", "_o").alias("hi")
                      ).drop("_n", "_nb", "_o")


def tile_mask(blk: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Pairs (i, j) a tile has to look at, once each: i < j inside a block, block ``lo`` x ``hi`` else."""
    n = len(blk)
    if lo == hi:
        return np.triu(np.ones((n, n), bool), 1)
    return np.outer(blk == lo, blk == hi)


def local_roots(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix: the smallest index each row can reach."""
    n = len(linked)
    label = np.arange(n)
    while True:
        new = np.minimum(label, np.where(linked, label[None, :], n).min(axis=1, initial=n))
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """Connected components of ``edges (a, b)``: one row ``(node, root)`` for each
    node that has an edge; ``root`` is the smallest node it can reach.

    Alternates two star contractions (every node hands its larger, then its
    smaller neighbours to the smallest one) until the edges are stars. Each
    round is grouped minima and equi-joins; a hub's rows are only joined, never gathered,
    so Spark can split them. Rounds grow with the logarithm of a component's size.
    Null ends and loops are dropped.
    """
    e = scratch.table(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    while True:
        # one job measures the edges and tells when a round changed nothing
        now = tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before or now[0] == 0:
            return _stars(e)
        before = now
        both = e.select(F.col("u").alias("n"), F.col("v").alias("x")).union(
            e.select(F.col("v").alias("n"), F.col("u").alias("x")))
        low = both.groupBy("n").agg(F.min("x").alias("m"))
        large = (both.where("x > n").join(low, "n")
                 .select(F.col("x").alias("u"), F.least("n", "m").alias("v")).distinct())
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        handed = large.join(small, "u")
        nxt = handed.select("u", F.col("m").alias("v")).union(
            handed.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
        new = scratch.table(nxt)
        scratch.drop(e)
        e = new


def _stars(e: DataFrame) -> DataFrame:
    rows = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return rows.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def column(table: pa.Table | pa.RecordBatch, name: str) -> pa.Array:
    c = table.column(name)
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def numbers(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    return column(table, name).to_numpy(zero_copy_only=False)


def list_values(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets (from 0) of a list column without null lists."""
    off = arr.offsets.to_numpy()
    return arr.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]], off - off[0]


def byte_slices(batch: pa.RecordBatch, name: str, limit: int):
    """Cut a batch so that a slice's ``name`` column has about ``limit`` bytes (one row at least)."""
    off = batch.column(name).cast(pa.large_string()).buffers()[1]
    arr = batch.column(name).cast(pa.large_string())
    ends = np.frombuffer(off, np.int64)[arr.offset:arr.offset + len(arr) + 1]
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(ends, ends[at] + limit, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to
