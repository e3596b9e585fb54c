"""Training dataset build: observation grid + 22 features + forward label.

Two plans with one semantics (tests check they agree):

* **Plan B (bucket)**, the default: ``bucket_rollup`` (one partial/final hash
  aggregate per (station, bucket)), then *one* window pass over the
  bucket rows, partitioned by station. The buckets are a lattice: their length is the greatest common
  divisor of the grid interval, all offsets, windows and the label horizon, so each frame is "whole buckets
  in a range" plus the at-start / after-start piece of one edge bucket, for any interval. Window rows per
  station are time span / bucket length, whatever the reading volume.
* **Plan A (union)**: left rows unioned with raw readings and one window pass
  over readings; works for any left timestamps and any offsets, but sliding
  24h frames are recomputed per reading. The cross-check.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockwatch.functions.nulls import nsum
from dockwatch.functions.timeexpr import BUCKET_ORIGIN_US, MINUTE_US, bucket_micros, floor_to, from_micros
from dockwatch.operators.rollup import bucket_rollup, reading_record, with_micros
from dockwatch.plans.features import (
    LAG_FEATURES,
    LONG_WINDOW_MIN,
    SHORT_WINDOW_MIN,
    W_LONG,
    W_SHORT,
    with_features,
)
from dockwatch.settings import DATASET_COLUMNS, FEATURE_COLUMNS, Settings

UNB = Window.unboundedPreceding
PART_COLUMNS = (
    ["snap"] + [f"asof_{o}" for o in LAG_FEATURES]
    + [f"w{SHORT_WINDOW_MIN}_{s}" for s in W_SHORT]
    + [f"w{LONG_WINDOW_MIN}_{s}" for s in W_LONG]
)


def lattice_min(s: Settings) -> int:
    """Bucket length (minutes) of plan B."""
    return math.gcd(s.sample_interval_min, s.label_horizon_min, *LAG_FEATURES, SHORT_WINDOW_MIN, LONG_WINDOW_MIN)


# --------------------------------------------------------------------------
# Plan B: bucket rows
# --------------------------------------------------------------------------

def bucket_parts(readings: DataFrame, s: Settings, with_label: bool = True) -> DataFrame:
    """Parts (see ``plans.features``) for every grid point ``b`` (micros) of a station, and other bucket
    starts, plus ``cap_ok`` (1 for the points of the observation grid), ``fwd_n`` and ``fwd_bmin``."""
    step = lattice_min(s)
    iv = step * MINUTE_US
    roll = bucket_rollup(readings, step, s.min_capacity, split_at_start=True)
    if step != s.sample_interval_min:
        roll = _marked(roll, s)
    w = Window.partitionBy("station_id").orderBy("b")

    def fr(lo, hi):
        return w.rangeBetween(lo, hi)

    cols: list[Column] = [
        F.greatest(F.max("f_rec").over(fr(UNB, -1)), F.col("s_rec")).alias("snap")
    ]
    for off in LAG_FEATURES:
        o = off * MINUTE_US
        cols.append(F.greatest(F.max("f_rec").over(fr(UNB, -o - 1)),
                               F.max("s_rec").over(fr(-o, -o))).alias(f"asof_{off}"))
    for wmin, stats in ((SHORT_WINDOW_MIN, W_SHORT), (LONG_WINDOW_MIN, W_LONG)):
        # [t - W, t] = whole buckets in [t - W, t - iv] + at-start rows of t
        fw = fr(-wmin * MINUTE_US, -iv)
        for st in stats:
            name = f"w{wmin}_{st}"
            if st in ("bmin",):
                e = F.least(F.min(f"f_{st}").over(fw), F.col(f"s_{st}"))
            elif st in ("bmax",):
                e = F.greatest(F.max(f"f_{st}").over(fw), F.col(f"s_{st}"))
            elif st in ("bcnt", "rcnt"):
                e = F.coalesce(F.sum(f"f_{st}").over(fw), F.lit(0)) + F.coalesce(f"s_{st}", F.lit(0))
            else:
                e = nsum(F.sum(f"f_{st}").over(fw), F.col(f"s_{st}"))
            cols.append(e.alias(name))
    if with_label:
        # (t, t + H] = after-start rows of t + whole buckets in [t + iv, t + H - iv]
        #            + at-start rows of bucket t + H
        h = s.label_horizon_min * MINUTE_US
        n_parts = [F.coalesce(F.col("a_n"), F.lit(0))]
        min_parts = [F.col("a_bmin")]
        if h - iv >= iv:
            mid = fr(iv, h - iv)
            n_parts.append(F.coalesce(F.sum("f_n").over(mid), F.lit(0)))
            min_parts.append(F.min("f_bmin").over(mid))
        end = fr(h, h)
        n_parts.append(F.coalesce(F.sum("s_n").over(end), F.lit(0)))
        min_parts.append(F.min("s_bmin").over(end))
        fwd_n = n_parts[0]
        for p in n_parts[1:]:
            fwd_n = fwd_n + p
        cols += [fwd_n.alias("fwd_n"), F.least(*min_parts).alias("fwd_bmin")]
    return roll.select("station_id", "b", "cap_ok", *cols)


def _marked(roll: DataFrame, s: Settings) -> DataFrame:
    """Lattice rows where ``cap_ok`` marks the points of a coarser grid: a point counts if any bucket of its interval holds a
    qualifying reading, and it may lie in a bucket without readings. Such points are added; no
    reading row is touched again."""
    point = floor_to("b", s.sample_interval_min * MINUTE_US, BUCKET_ORIGIN_US)
    points = roll.where("cap_ok = 1").select("station_id", point.alias("b"), F.lit(1).alias("__point")).distinct()
    # both sides are one row per (station, bucket)
    return roll.join(points, ["station_id", "b"], "full").withColumn(
        "cap_ok", F.coalesce("__point", F.lit(0))).drop("__point")


# --------------------------------------------------------------------------
# Plan A: union of left rows and raw readings
# --------------------------------------------------------------------------

def union_parts(readings: DataFrame, left: DataFrame, s: Settings,
                with_label: bool = True) -> DataFrame:
    """Parts for arbitrary left rows ``(station_id, obs_us)`` by one window over
    left rows unioned with the readings of the same stations."""
    r = with_micros(readings).select(
        "station_id",
        F.col("ts_us").alias("k"),
        reading_record().alias("rec"),
        F.col("avg_bikes_available").alias("bikes"),
        F.col("avg_availability_ratio").alias("ratio"),
        F.col("low_availability_events").alias("low"),
        F.col("event_count").alias("ev"),
        F.lit(1).alias("one"),
        F.lit(False).alias("is_left"),
    )
    lft = left.select("station_id", F.col("obs_us").alias("k"), F.lit(True).alias("is_left"))
    # only stations that have a left row matter: semi join prunes the rest
    r = r.join(lft.select("station_id").distinct(), "station_id", "left_semi")
    u = r.unionByName(lft, allowMissingColumns=True)
    w = Window.partitionBy("station_id").orderBy("k")
    cols = [F.max("rec").over(w.rangeBetween(UNB, 0)).alias("snap")]
    for off in LAG_FEATURES:
        o = off * MINUTE_US
        cols.append(F.max("rec").over(w.rangeBetween(UNB, -o)).alias(f"asof_{off}"))
    for wmin, stats in ((SHORT_WINDOW_MIN, W_SHORT), (LONG_WINDOW_MIN, W_LONG)):
        fw = w.rangeBetween(-wmin * MINUTE_US, 0)
        agg = {
            "bsum": F.sum("bikes"), "bcnt": F.count("bikes"), "bmin": F.min("bikes"),
            "bmax": F.max("bikes"), "rsum": F.sum("ratio"), "rcnt": F.count("ratio"),
            "low": F.sum("low"), "ev": F.sum("ev"),
        }
        cols += [agg[st].over(fw).alias(f"w{wmin}_{st}") for st in stats]
    if with_label:
        fwd = w.rangeBetween(1, s.label_horizon_min * MINUTE_US)
        cols += [F.count("one").over(fwd).alias("fwd_n"),
                 F.min("bikes").over(fwd).alias("fwd_bmin")]
    out = u.select("station_id", "k", "is_left", *cols).filter(F.col("is_left"))
    return out.withColumnRenamed("k", "obs_us").drop("is_left")


def grid_rows(readings: DataFrame, s: Settings) -> DataFrame:
    """Observation grid as (station_id, obs_us): DISTINCT bucket of qualifying readings."""
    r = with_micros(readings).filter(F.col("avg_capacity") >= F.lit(s.min_capacity))
    return (r.select("station_id", bucket_micros("ts_us", s.sample_interval_min).alias("obs_us"))
            .distinct())


# --------------------------------------------------------------------------
# Assembly
# --------------------------------------------------------------------------

def _label_cols(s: Settings) -> list[Column]:
    return [
        F.timestamp_add("MINUTE", F.lit(s.label_horizon_min), F.col("obs_ts")).alias(
            "label_window_end"),
        F.when(F.col("fwd_bmin") < F.lit(s.empty_threshold), 1).otherwise(0).cast("int").alias(
            "target_empty_next_hour"),
        F.col("fwd_n").cast("long").alias("fwd_row_count"),
    ]


def dataset_parts(readings: DataFrame, s: Settings, plan: str = "auto") -> DataFrame:
    """Grid rows with parts and forward stats, before the label filter.

    Columns: station_id, obs_ts, parts, fwd_n, fwd_bmin."""
    if plan == "auto":
        plan = "bucket"
    if plan == "bucket":
        p = bucket_parts(readings, s).filter(F.col("cap_ok") == 1).withColumnRenamed("b", "obs_us")
    elif plan == "union":
        p = union_parts(readings, grid_rows(readings, s), s)
    else:
        raise ValueError(f"unknown plan {plan!r}")
    return p.withColumn("obs_ts", from_micros("obs_us"))


def build_dataset(readings: DataFrame, s: Settings | None = None, plan: str = "auto") -> DataFrame:
    """The 27-column training dataset (unordered; the sink orders it)."""
    s = s or Settings()
    p = dataset_parts(readings, s, plan)
    p = p.filter(F.col("snap").isNotNull() & (F.col("fwd_n") >= F.lit(s.min_forward_rows)))
    p = with_features(p.select("station_id", "obs_ts", "fwd_n", "fwd_bmin", *PART_COLUMNS),
                      FEATURE_COLUMNS)
    p = p.select("*", F.col("obs_ts").alias("feature_cutoff_ts"), *_label_cols(s))
    return p.select(*DATASET_COLUMNS)


def forward_label(readings: DataFrame, s: Settings | None = None, plan: str = "auto") -> DataFrame:
    """(station_id, obs_ts, label_window_end, target_empty_next_hour, fwd_row_count)
    for grid points with at least ``min_forward_rows`` readings in (t, t + H]."""
    s = s or Settings()
    if plan == "auto":
        plan = "bucket"
    if plan == "bucket":
        p = bucket_parts(readings, s).filter(F.col("cap_ok") == 1).withColumnRenamed("b", "obs_us")
    else:
        p = union_parts(readings, grid_rows(readings, s), s)
    p = p.withColumn("obs_ts", from_micros("obs_us"))
    p = p.filter(F.col("fwd_n") >= F.lit(s.min_forward_rows))
    return p.select("station_id", "obs_ts", *_label_cols(s))


def forward_counts(readings: DataFrame, s: Settings | None = None) -> DataFrame:
    """Every grid point with its forward row count and label (no threshold):
    the basis of the coverage reports. ``fwd_n`` may be 0."""
    s = s or Settings()
    p = bucket_parts(readings, s)
    p = p.filter(F.col("cap_ok") == 1).select(
        "station_id", from_micros("b").alias("obs_ts"),
        F.col("fwd_n").cast("long").alias("fwd_row_count"),
        F.when(F.col("fwd_bmin") < F.lit(s.empty_threshold), 1).otherwise(0).cast("int").alias(
            "target"),
    )
    return p
