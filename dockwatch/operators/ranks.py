"""Running sums over a whole (grouped) table in order, without a window over all of it.

A running sum over ``Window.orderBy`` puts every row of a group into one task. Here the rows are range-partitioned by
(group, order) — as many ranges as their bytes ask for — and written with the number of their range; each range's totals,
one row per range and group, are scanned once; and the sums inside a range come from a window over that range only.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockwatch.session import ensure_checkpoint_dir


def running_sums(df: DataFrame, order: str, sums: Sequence[str], group: Sequence[str] = (), descending: bool = False,
                 ranges: int | None = None) -> DataFrame:
    """``df`` with ``{c}_before`` for each column of ``sums``: its sum over the rows of the same group that come strictly before
    in ``order`` (a column whose values differ within a group), and ``{c}_total``: its sum over the group. NULLs count as 0.

    ``ranges`` fixes the number of ranges; by default it follows ``spark.sql.shuffle.partitions`` and the size of the
    data. The rows are written once to the folder named by ``spark.checkpoint.dir``."""
    spark, keys = df.sparkSession, list(group)
    by: Column = F.desc(order) if descending else F.asc(order)
    cut = [F.asc(k) for k in keys] + [by]
    dealt = df.repartitionByRange(ranges, *cut) if ranges else df.repartitionByRange(*cut)
    dealt = dealt.withColumn("__range", F.spark_partition_id())
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ranges-{uuid.uuid4().hex}"
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)

    # a literal stands for the key of an ungrouped table: this table has a row per range and group
    scan = Window.partitionBy(*(keys or [F.lit(0)]))
    earlier = scan.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(*keys, "__range").agg(*(F.sum(c).alias(c) for c in sums))
    totals = totals.select(*(F.col(k).alias(f"__g{i}") for i, k in enumerate(keys)), "__range",
                           *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__{c}_off") for c in sums),
                           *(F.coalesce(F.sum(c).over(scan), F.lit(0)).alias(f"{c}_total") for c in sums)
                           ).withColumnRenamed("__range", "__r")
    inside = Window.partitionBy(*keys, "__range").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.select("*", *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"__{c}_in") for c in sums))
    same = F.col("__range") == F.col("__r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__g{i}"))
    out = out.join(totals, same)
    return out.select(*df.columns, *((F.col(f"__{c}_off") + F.col(f"__{c}_in")).alias(f"{c}_before") for c in sums),
                      *(f"{c}_total" for c in sums))
