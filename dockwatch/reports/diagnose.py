"""Dataset-quality diagnostics: attrition, forward coverage, threshold
sensitivity, station inspection. Every report is a DataFrame; all of them
start from one pass over the readings (``bucket_parts`` / ``forward_counts``).
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dockwatch.functions.timeexpr import MINUTE_US, from_micros, micros, ntz_literal
from dockwatch.operators.percentiles import percentiles_from_hist
from dockwatch.operators.ranges import range_join
from dockwatch.plans.dataset import bucket_parts, forward_counts
from dockwatch.settings import SENSITIVITY_THRESHOLDS, Settings

QUARTILES = (0.25, 0.5, 0.75)


def _pct(num, den):
    """num / den * 100, 0 when den is 0 (as the console report does)."""
    return F.when(den > 0, num.cast("double") / den * 100).otherwise(F.lit(0.0))


def station_attrition(readings: DataFrame, s: Settings) -> DataFrame:
    """Distinct stations at each stage: source, capacity ok, forward coverage ok."""
    p = bucket_parts(readings, s)
    per_station = p.groupBy("station_id").agg(
        F.max("cap_ok").alias("cap"),
        F.max(F.when((F.col("cap_ok") == 1) & (F.col("fwd_n") >= s.min_forward_rows), 1)
              .otherwise(0)).alias("fwd"),
    )
    t = per_station.agg(
        F.count(F.lit(1)).alias("source_stations"),
        F.coalesce(F.sum("cap"), F.lit(0)).cast("long").alias("after_capacity"),
        F.coalesce(F.sum("fwd"), F.lit(0)).cast("long").alias("after_forward"),
    )
    return t.select(
        "source_stations", "after_capacity", "after_forward",
        (F.col("source_stations") - F.col("after_capacity")).alias("dropped_capacity"),
        (F.col("after_capacity") - F.col("after_forward")).alias("dropped_forward"),
        _pct(F.col("source_stations") - F.col("after_capacity"), F.col("source_stations"))
        .alias("capacity_drop_pct"),
        _pct(F.col("after_capacity") - F.col("after_forward"), F.col("after_capacity"))
        .alias("forward_drop_pct"),
    )


def forward_count_hist(readings: DataFrame, s: Settings) -> DataFrame:
    """(fwd_row_count, obs, pos) over grid points with at least one forward row."""
    fc = forward_counts(readings, s).filter(F.col("fwd_row_count") > 0)
    return fc.groupBy("fwd_row_count").agg(
        F.count(F.lit(1)).alias("obs"), F.sum("target").cast("long").alias("pos"))


def forward_count_dist(readings: DataFrame, s: Settings) -> DataFrame:
    """total / passing observations and min, quartiles, max of forward counts."""
    h = forward_count_hist(readings, s)
    return percentiles_from_hist(
        h, "fwd_row_count", "obs", QUARTILES, names=["p25_fwd", "p50_fwd", "p75_fwd"],
        extra_aggs=[
            F.coalesce(F.sum("obs"), F.lit(0)).cast("long").alias("total_obs"),
            F.coalesce(F.sum(F.when(F.col("fwd_row_count") >= s.min_forward_rows, F.col("obs"))
                             .otherwise(0)), F.lit(0)).cast("long").alias("passing_obs"),
            F.min("fwd_row_count").alias("min_fwd"),
            F.max("fwd_row_count").alias("max_fwd"),
        ],
    ).select("total_obs", "passing_obs", "min_fwd", "p25_fwd", "p50_fwd", "p75_fwd", "max_fwd")


def zero_forward_obs(readings: DataFrame, s: Settings) -> DataFrame:
    """Grid points with no reading in (t, t + H] (the anti join)."""
    return forward_counts(readings, s).filter(F.col("fwd_row_count") == 0).select(
        "station_id", "obs_ts")


def obs_attrition(readings: DataFrame, s: Settings) -> DataFrame:
    fc = forward_counts(readings, s)
    t = fc.agg(
        F.count(F.lit(1)).alias("total_grid"),
        F.count(F.when(F.col("fwd_row_count") == 0, 1)).alias("zero_forward"),
        F.count(F.when(F.col("fwd_row_count") > 0, 1)).alias("with_forward"),
        F.count(F.when(F.col("fwd_row_count") >= s.min_forward_rows, 1)).alias("passing"),
    )
    return t.select("*", (F.col("passing").cast("double") / F.nullif(F.col("total_grid"), F.lit(0))
                          * 100).alias("passing_pct_of_grid"))


def forward_sensitivity(spark: SparkSession, readings: DataFrame, s: Settings,
                        thresholds: Sequence[int] = SENSITIVITY_THRESHOLDS) -> DataFrame:
    """Per min_forward_rows threshold: stations, observations, share of the grid
    (observations with any forward row), positive rate and count quartiles.
    One job for all thresholds; thresholds nobody passes still get a row."""
    fc = forward_counts(readings, s).filter(F.col("fwd_row_count") > 0)
    hist = fc.groupBy("fwd_row_count").agg(
        F.count(F.lit(1)).alias("obs"), F.sum("target").cast("long").alias("pos"))
    smax = fc.groupBy("station_id").agg(F.max("fwd_row_count").alias("smax"))
    # the threshold list is a job parameter: its size is bounded by the caller
    th = spark.createDataFrame([(int(t),) for t in sorted(set(thresholds))], "threshold int")
    th = F.broadcast(th)
    per = hist.join(th, hist["fwd_row_count"] >= th["threshold"], "inner")
    q = percentiles_from_hist(
        per, "fwd_row_count", "obs", QUARTILES, group_cols=["threshold"],
        names=["p25_fwd", "p50_fwd", "p75_fwd"],
        extra_aggs=[F.sum("obs").alias("obs_n"), F.sum("pos").alias("pos_n"),
                    F.min("fwd_row_count").alias("min_fwd"), F.max("fwd_row_count").alias("max_fwd")],
    )
    st = smax.join(th, smax["smax"] >= th["threshold"], "inner").groupBy("threshold").agg(
        F.count(F.lit(1)).alias("stations"))
    total = hist.agg(F.coalesce(F.sum("obs"), F.lit(0)).alias("total_grid"))
    out = th.join(q, "threshold", "left").join(st, "threshold", "left").crossJoin(
        F.broadcast(total))
    obs = F.coalesce(F.col("obs_n"), F.lit(0)).cast("long")
    pos = F.coalesce(F.col("pos_n"), F.lit(0)).cast("long")
    return out.select(
        "threshold",
        F.coalesce(F.col("stations"), F.lit(0)).cast("long").alias("stations"),
        obs.alias("obs"),
        _pct(obs, F.col("total_grid")).alias("pct_grid"),
        _pct(pos, obs).alias("pos_rate"),
        "min_fwd", "p25_fwd", "p50_fwd", "p75_fwd", "max_fwd",
    )


def station_capacity(readings: DataFrame) -> DataFrame:
    return readings.groupBy("station_id").agg(F.avg("avg_capacity").alias("avg_capacity"))


def station_reading_count(readings: DataFrame, station_id: str) -> int:
    """Existence check of one station (A9): a pushed-down filter and a count."""
    return readings.filter(F.col("station_id") == station_id).count()


# --------------------------------------------------------------------------
# Inspection
# --------------------------------------------------------------------------

def inspect_dataset(dataset: DataFrame, station_id: str | None = None,
                    start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Dataset rows of one station (or all) within [start, end]. The station
    predicate is pushed through the window to the scan; the time bounds are
    applied after it (as-of look-back is unbounded)."""
    d = dataset
    if station_id is not None:
        d = d.filter(F.col("station_id") == station_id)
    if start is not None:
        d = d.filter(F.col("obs_ts") >= ntz_literal(start))
    if end is not None:
        d = d.filter(F.col("obs_ts") <= ntz_literal(end))
    return d


def _obs_keys(obs: DataFrame) -> DataFrame:
    return obs.select("station_id", "obs_ts").withColumn("obs_us", micros("obs_ts"))


def _raw(readings: DataFrame) -> DataFrame:
    return readings.select(
        "station_id", "window_start", "avg_bikes_available", "avg_docks_available",
        "avg_capacity", "avg_availability_ratio",
    ).withColumn("ts_us", micros("window_start"))


def inspect_raw_around(readings: DataFrame, obs: DataFrame, minutes: int = 5) -> DataFrame:
    """Raw readings within [t - m, t + m] of each inspected observation, with
    ``is_obs`` marking the reading that starts exactly at t."""
    o = _obs_keys(obs)
    o = o.withColumn("lo", F.col("obs_us") - minutes * MINUTE_US).withColumn(
        "hi", F.col("obs_us") + minutes * MINUTE_US)
    j = range_join(o, _raw(readings), "station_id", "lo", "hi", "ts_us",
                   bin_us=2 * minutes * MINUTE_US)
    return j.select(
        "station_id", "obs_ts", "window_start", "avg_bikes_available", "avg_docks_available",
        "avg_capacity", "avg_availability_ratio",
        (F.col("ts_us") == F.col("obs_us")).alias("is_obs"),
    )


def inspect_forward_rows(readings: DataFrame, obs: DataFrame, s: Settings) -> DataFrame:
    """Raw readings in (t, t + H] of each observation with the ``is_low`` marker
    (bikes below the configured empty threshold)."""
    h = s.label_horizon_min * MINUTE_US
    o = _obs_keys(obs).withColumn("hi", F.col("obs_us") + h)
    j = range_join(o, _raw(readings), "station_id", "obs_us", "hi", "ts_us",
                   bin_us=h, lo_inclusive=False)
    return j.select(
        "station_id", "obs_ts", "window_start", "avg_bikes_available", "avg_docks_available",
        "avg_availability_ratio",
        (F.col("avg_bikes_available") < F.lit(s.empty_threshold)).alias("is_low"),
    )


def inspect_forward_trim(forward_rows: DataFrame, head: int = 3) -> DataFrame:
    """First and last ``head`` forward rows per observation (all when <= 2*head),
    with position and total; windows run per observation (<= H rows each)."""
    w = Window.partitionBy("station_id", "obs_ts").orderBy("window_start")
    f = forward_rows.withColumn("row_pos", F.row_number().over(w)).withColumn(
        "n_rows", F.count(F.lit(1)).over(Window.partitionBy("station_id", "obs_ts")))
    keep = (F.col("n_rows") <= 2 * head) | (F.col("row_pos") <= head) | (
        F.col("row_pos") > F.col("n_rows") - head)
    return f.filter(keep).withColumn("row_pos", F.col("row_pos").cast("long"))


def label_justification(forward_rows: DataFrame, s: Settings) -> DataFrame:
    """Per observation: forward row count, min bikes and the label it implies."""
    return forward_rows.groupBy("station_id", "obs_ts").agg(
        F.count(F.lit(1)).alias("fwd_rows"),
        F.min("avg_bikes_available").alias("min_bikes_fwd"),
    ).withColumn("implied_label", F.when(F.col("min_bikes_fwd") < s.empty_threshold, 1)
                 .otherwise(0).cast("int"))


def bucket_start(df: DataFrame, col: str = "b") -> DataFrame:
    return df.withColumn("obs_ts", from_micros(col))
