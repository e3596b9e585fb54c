"""Bucket rollup: per (key, time bucket) partial statistics of readings.

This is the map-side-combinable first stage of the grid-aligned plans. A
station holding a third of all readings still collapses to one row per
bucket here (partial aggregation before the shuffle), so everything
downstream is sized by time span x stations, not by reading volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwatch.functions.timeexpr import BUCKET_ORIGIN_US, MINUTE_US, floor_to, micros
from dockwatch.operators.newest import key_time, newest_aggs, newest_key, newest_record

# Values of a newest reading (its struct has ``ts`` before them) and their columns.
REC_VALUES = {
    "bikes": "avg_bikes_available", "docks": "avg_docks_available",
    "ratio": "avg_availability_ratio", "cap": "avg_capacity",
}
STAT_NAMES = ("n", "bsum", "bcnt", "bmin", "bmax", "rsum", "rcnt", "low", "ev", "rec")


def with_micros(readings: DataFrame) -> DataFrame:
    """Add ``ts_us`` / ``em_us`` (long micros of window_start / emitted_at)."""
    return readings.withColumn("ts_us", micros("window_start")).withColumn(
        "em_us", micros("emitted_at"))


def reading_record() -> Column:
    """A reading as one orderable value: the newest (window_start, emitted_at) is the largest. For
    windows; an aggregate over raw readings takes ``operators.newest`` instead."""
    return F.struct(
        F.col("ts_us").alias("ts"),
        F.col("em_us").alias("em"),
        F.col("avg_bikes_available").alias("bikes"),
        F.col("avg_docks_available").alias("docks"),
        F.col("avg_availability_ratio").alias("ratio"),
        F.col("avg_capacity").alias("cap"),
    )


def piece_aggs(prefix: str, cond: Column | None = None,
               stats: tuple[str, ...] = STAT_NAMES, key: Column | None = None) -> list[Column]:
    """Aggregates of one piece of a group (rows matching ``cond``). ``rec`` needs the packed ``key`` and
    is put together from its columns after the aggregation."""

    def v(c: str | Column) -> Column:
        col = F.col(c) if isinstance(c, str) else c
        return col if cond is None else F.when(cond, col)

    bikes, ratio = "avg_bikes_available", "avg_availability_ratio"
    defs = {
        "n": F.count(v(F.lit(1))),
        "bsum": F.sum(v(bikes)),
        "bcnt": F.count(v(bikes)),
        "bmin": F.min(v(bikes)),
        "bmax": F.max(v(bikes)),
        "rsum": F.sum(v(ratio)),
        "rcnt": F.count(v(ratio)),
        "low": F.sum(v("low_availability_events")),
        "ev": F.sum(v("event_count")),
    }
    out = [defs[s].alias(f"{prefix}_{s}") for s in stats if s != "rec"]
    if "rec" in stats:
        out += newest_aggs(key, {n: F.col(c) for n, c in REC_VALUES.items()}, f"{prefix}_rec", cond)
    return out


def bucket_rollup(readings: DataFrame, interval_min: int, min_capacity: float | None = None,
                  split_at_start: bool = True, origin_us: int = BUCKET_ORIGIN_US) -> DataFrame:
    """Group readings by (station_id, bucket start ``b``); buckets are counted from ``origin_us``. One
    hash aggregate, the newest readings included.

    Columns: ``f_*`` over the whole bucket; with ``split_at_start`` also ``s_*``
    over rows exactly at the bucket start and ``a_n`` / ``a_bmin`` over the rows
    after it; with ``min_capacity`` a ``cap_ok`` flag (some reading has
    capacity >= min_capacity: the bucket is a grid point).
    """
    r = with_buckets(readings, interval_min, origin_us)
    return rollup_rows(r, interval_min, min_capacity, split_at_start)


def with_buckets(readings: DataFrame, interval_min: int, origin_us: int = BUCKET_ORIGIN_US) -> DataFrame:
    """Add the bucket start ``b`` and the packed key ``k`` (see ``operators.newest``) of each reading."""
    span = interval_min * MINUTE_US
    r = with_micros(readings).withColumn("b", floor_to("ts_us", span, origin_us))
    return r.withColumn("k", newest_key(F.col("ts_us"), F.col("em_us"), F.col("b"), span))


def rollup_rows(r: DataFrame, interval_min: int, min_capacity: float | None = None,
                split_at_start: bool = True) -> DataFrame:
    """:func:`bucket_rollup` of rows that have ``b`` and ``k`` already."""
    span = interval_min * MINUTE_US
    key = F.col("k")
    aggs, records = piece_aggs("f", key=key), ["f"]
    if split_at_start:
        at_start = key_time(key, F.col("b"), span) == F.col("b")
        aggs += piece_aggs("s", at_start, key=key)
        aggs += piece_aggs("a", ~at_start, stats=("n", "bmin"))
        records.append("s")
    if min_capacity is not None:
        aggs.append(F.max(F.when(F.col("avg_capacity") >= F.lit(min_capacity), 1).otherwise(0))
                    .alias("cap_ok"))
    g = r.groupBy("station_id", "b").agg(*aggs)
    parts = [f"{p}_rec_{n}" for p in records for n in ("key", *REC_VALUES)]
    return g.select(*[c for c in g.columns if c not in parts],
                    *[newest_record(f"{p}_rec", tuple(REC_VALUES), F.col("b"), span).alias(f"{p}_rec")
                      for p in records])
