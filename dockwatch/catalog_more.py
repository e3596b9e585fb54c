"""Further query groups (imported by ``catalog`` to register them)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwatch import oracles as O
from dockwatch.catalog import S, register
from dockwatch.functions.timeexpr import from_micros
from dockwatch.operators.asof import asof_join
from dockwatch.plans import dataset as D
from dockwatch.plans.features import LAG_FEATURES, feature_exprs
from dockwatch.reports import diagnose as G
from dockwatch.reports import validation as V
from dockwatch.settings import DATASET_COLUMNS, SENSITIVITY_THRESHOLDS
from dockwatch.sources.readings import readings_for

# ---------------------------------------------------------------- features


def _grid_parts(spark: SparkSession, d: str) -> DataFrame:
    return D.dataset_parts(readings_for(spark, d), S, plan="bucket")


def _feat(names):
    ex = feature_exprs()
    return [ex[n].alias(n) for n in names]


SNAP_COLS = ["ft_bikes_available", "ft_docks_available", "ft_availability_ratio", "ft_capacity"]


@register("asof_snapshot", O.with_base(S, "SELECT * FROM snap"))
def q_asof_snapshot(spark, d):
    p = _grid_parts(spark, d).filter(F.col("snap").isNotNull())
    return p.select("station_id", "obs_ts", from_micros(F.col("snap")["ts"]).alias(
        "snapshot_source_ts"), *_feat(SNAP_COLS))


@register("asof_snapshot_generic", O.with_base(S, "SELECT * FROM snap"))
def q_asof_snapshot_generic(spark, d):
    """The same snapshot through the generic, domain-neutral as-of operator."""
    r = readings_for(spark, d)
    g = D.grid_rows(r, S).select("station_id", from_micros("obs_us").alias("obs_ts"))
    j = asof_join(g, r, "station_id", "obs_ts", "window_start",
                  ["avg_bikes_available", "avg_docks_available", "avg_availability_ratio",
                   "avg_capacity"], tie_breakers=["emitted_at"], how="inner")
    return j.select(
        "station_id", "obs_ts", F.col("window_start").alias("snapshot_source_ts"),
        F.col("avg_bikes_available").alias("ft_bikes_available"),
        F.col("avg_docks_available").alias("ft_docks_available"),
        F.col("avg_availability_ratio").alias("ft_availability_ratio"),
        F.col("avg_capacity").alias("ft_capacity"),
    )


LAG_COLS = list(LAG_FEATURES.values())


@register("asof_lags", O.with_base(S, f"SELECT station_id, obs_ts, {', '.join(LAG_COLS)} FROM grid_feat"))
def q_asof_lags(spark, d):
    return _grid_parts(spark, d).select("station_id", "obs_ts", *_feat(LAG_COLS))


R60 = ["ft_avg_bikes_60m", "ft_min_bikes_60m", "ft_max_bikes_60m", "ft_avg_ratio_60m"]
R24 = ["ft_avg_bikes_24h", "ft_min_bikes_24h", "ft_max_bikes_24h", "ft_low_avail_freq_24h"]


@register("rolling_60m", O.with_base(S, f"SELECT station_id, obs_ts, {', '.join(R60)} FROM roll"))
def q_rolling_60m(spark, d):
    return _grid_parts(spark, d).select("station_id", "obs_ts", *_feat(R60))


@register("rolling_24h", O.with_base(S, f"SELECT station_id, obs_ts, {', '.join(R24)} FROM roll"))
def q_rolling_24h(spark, d):
    return _grid_parts(spark, d).select("station_id", "obs_ts", *_feat(R24))


TEMP = ["ft_hour_of_day", "ft_day_of_week", "ft_is_weekend"]


@register("temporal_features", O.with_base(
    S, f"SELECT station_id, obs_ts, {O.TEMPORAL_SELECT.format(t='obs_ts')} FROM grid"))
def q_temporal_features(spark, d):
    g = D.grid_rows(readings_for(spark, d), S).select(
        "station_id", from_micros("obs_us").alias("obs_ts"))
    return g.select("station_id", "obs_ts", *_feat(TEMP))


CAPCTX = ["ft_capacity", "ft_pct_bikes_of_capacity", "ft_pct_docks_of_capacity",
          "ft_bikes_delta_60m"]


@register("capacity_context", O.with_base(S, """
SELECT s.station_id, s.obs_ts, s.ft_capacity,
  s.ft_bikes_available / NULLIF(s.ft_capacity, 0) AS ft_pct_bikes_of_capacity,
  s.ft_docks_available / NULLIF(s.ft_capacity, 0) AS ft_pct_docks_of_capacity,
  s.ft_bikes_available - r.ft_avg_bikes_60m AS ft_bikes_delta_60m
FROM snap s LEFT JOIN roll r ON s.station_id = r.station_id AND s.obs_ts = r.obs_ts"""))
def q_capacity_context(spark, d):
    p = _grid_parts(spark, d).filter(F.col("snap").isNotNull())
    return p.select("station_id", "obs_ts", *_feat(CAPCTX))


# ---------------------------------------------------------------- dataset I/O


_SUMMARY_SQL = """
SELECT COUNT(*) AS row_count,
  COUNT(*) FILTER (WHERE target_empty_next_hour = 1) AS positive_count,
  COUNT(DISTINCT station_id) AS station_count,
  MIN(obs_ts) AS obs_ts_min, MAX(obs_ts) AS obs_ts_max,
  CASE WHEN COUNT(*) > 0 THEN (COUNT(*) FILTER (WHERE target_empty_next_hour = 1))::DOUBLE / COUNT(*) ELSE 0.0 END AS positive_rate
FROM dataset"""


@register("dataset_summary", O.with_dataset(S, _SUMMARY_SQL))
def q_dataset_summary(spark, d):
    return V.dataset_summary(D.build_dataset(readings_for(spark, d), S))


def _written(spark, d):
    """The dataset written to the shared checkpoint area (the sink of the build job); its path."""
    from dockwatch.session import ensure_checkpoint_dir
    from dockwatch.sources.artifacts import write_dataset

    base = ensure_checkpoint_dir(spark).rstrip("/") + "/dockwatch-roundtrip"
    return write_dataset(D.build_dataset(readings_for(spark, d), S), base, spark=spark)


@register("dataset_roundtrip", O.with_dataset(S, "SELECT * FROM dataset"))
def q_dataset_roundtrip(spark, d):
    from dockwatch.sources.artifacts import load_dataset

    return load_dataset(spark, _written(spark, d))


@register("written_summary", O.with_dataset(S, _SUMMARY_SQL))
def q_written_summary(spark, d):
    """The summary that the sink left in the footers."""
    from dockwatch.sources.artifacts import written_summary

    return written_summary(spark, _written(spark, d))


# a morning of one station: one day's partition, and a true part of it
ONE_STATION, ONE_START, ONE_END = "1", datetime(2024, 1, 1, 6), datetime(2024, 1, 1, 12)


@register("inspect_station_day", O.with_dataset(S, f"""
SELECT * FROM dataset WHERE station_id = '{ONE_STATION}' AND obs_ts BETWEEN TIMESTAMP '{ONE_START}' AND TIMESTAMP '{ONE_END}'"""))
def q_inspect_station_day(spark, d):
    from dockwatch.sources.artifacts import load_dataset

    days = load_dataset(spark, _written(spark, d), ONE_START, ONE_END)
    return G.inspect_dataset(days, ONE_STATION, ONE_START, ONE_END)


# ---------------------------------------------------------------- validation


@register("validation_summary", O.with_dataset(S, """
SELECT COUNT(*) AS row_count, COUNT(DISTINCT station_id) AS station_count,
  MIN(obs_ts) AS obs_ts_min, MAX(obs_ts) AS obs_ts_max,
  COUNT(*) FILTER (WHERE target_empty_next_hour = 1) AS positive_count,
  CASE WHEN COUNT(*) > 0 THEN (COUNT(*) FILTER (WHERE target_empty_next_hour = 1))::DOUBLE / COUNT(*) ELSE 0.0 END AS positive_rate,
  COUNT(*) FILTER (WHERE target_empty_next_hour IS NOT NULL AND target_empty_next_hour NOT IN (0, 1)) AS non_binary_targets,
  (SELECT COALESCE(SUM(n - 1), 0)::BIGINT FROM (SELECT COUNT(*) AS n FROM dataset GROUP BY station_id, obs_ts)) AS duplicate_keys,
  COUNT(*) FILTER (WHERE NOT COALESCE(feature_cutoff_ts = obs_ts, false)) AS cutoff_mismatches,
  (CASE WHEN COUNT(*) > 0 THEN (COUNT(*) FILTER (WHERE target_empty_next_hour = 1))::DOUBLE / COUNT(*) ELSE 0.0 END) NOT BETWEEN 0.01 AND 0.50 AS positive_rate_warning
FROM dataset"""))
def q_validation_summary(spark, d):
    return V.validation_summary(D.build_dataset(readings_for(spark, d), S))


def _null_rates_sql() -> str:
    from dockwatch.settings import NULLABLE_COLUMNS
    parts = []
    for c in DATASET_COLUMNS:
        isnan = f" OR isnan({c})" if c.startswith("ft_") and c not in (
            "ft_hour_of_day", "ft_day_of_week", "ft_is_weekend") else ""
        nullable = "true" if c in NULLABLE_COLUMNS else "false"
        parts.append(
            f"SELECT '{c}' AS column_name, "
            f"COALESCE(AVG(CASE WHEN {c} IS NULL{isnan} THEN 1 ELSE 0 END) * 100, 0.0) AS null_pct, "
            f"{nullable} AS nullable FROM dataset")
    body = "\nUNION ALL ".join(parts)
    return O.with_dataset(S, f"""
SELECT column_name, null_pct, nullable,
  CASE WHEN null_pct = 0 THEN 'ok' WHEN nullable THEN 'WARN' ELSE 'FAIL' END AS severity
FROM ({body}) t""")


@register("validation_null_rates", _null_rates_sql())
def q_validation_null_rates(spark, d):
    return V.validation_null_rates(D.build_dataset(readings_for(spark, d), S))


@register("dataset_sample")
def q_dataset_sample(spark, d):
    return V.dataset_sample(D.build_dataset(readings_for(spark, d), S))


# ---------------------------------------------------------------- diagnostics

_SA = f"""
SELECT source_stations, after_capacity, after_forward,
  source_stations - after_capacity AS dropped_capacity,
  after_capacity - after_forward AS dropped_forward,
  CASE WHEN source_stations > 0 THEN (source_stations - after_capacity)::DOUBLE / source_stations * 100 ELSE 0.0 END AS capacity_drop_pct,
  CASE WHEN after_capacity > 0 THEN (after_capacity - after_forward)::DOUBLE / after_capacity * 100 ELSE 0.0 END AS forward_drop_pct
FROM (SELECT
  (SELECT COUNT(DISTINCT station_id) FROM readings) AS source_stations,
  (SELECT COUNT(DISTINCT station_id) FROM readings WHERE avg_capacity >= {S.min_capacity!r}) AS after_capacity,
  (SELECT COUNT(DISTINCT station_id) FROM fwd) AS after_forward) t"""


@register("station_attrition", O.with_base(S, _SA))
def q_station_attrition(spark, d):
    return G.station_attrition(readings_for(spark, d), S)


@register("forward_count_dist", O.with_base(S, f"""
SELECT COUNT(*) AS total_obs,
  SUM(CASE WHEN fwd_row_count >= {S.min_forward_rows} THEN 1 ELSE 0 END)::BIGINT AS passing_obs,
  MIN(fwd_row_count) AS min_fwd,
  PERCENTILE_CONT(0.25) WITHIN GROUP (ORDER BY fwd_row_count) AS p25_fwd,
  PERCENTILE_CONT(0.50) WITHIN GROUP (ORDER BY fwd_row_count) AS p50_fwd,
  PERCENTILE_CONT(0.75) WITHIN GROUP (ORDER BY fwd_row_count) AS p75_fwd,
  MAX(fwd_row_count) AS max_fwd
FROM fwd_all"""))
def q_forward_count_dist(spark, d):
    return G.forward_count_dist(readings_for(spark, d), S)


@register("zero_forward_obs", O.with_base(S, f"""
SELECT g.station_id, g.obs_ts FROM grid g
WHERE NOT EXISTS (SELECT 1 FROM readings m WHERE m.station_id = g.station_id
  AND m.window_start > g.obs_ts AND m.window_start <= g.obs_ts + INTERVAL {S.label_horizon_min} MINUTE)"""))
def q_zero_forward_obs(spark, d):
    return G.zero_forward_obs(readings_for(spark, d), S)


@register("obs_attrition", O.with_base(S, f"""
SELECT total_grid, zero_forward, with_forward, passing,
  passing::DOUBLE / NULLIF(total_grid, 0) * 100 AS passing_pct_of_grid
FROM (SELECT
  (SELECT COUNT(*) FROM grid) AS total_grid,
  (SELECT COUNT(*) FROM grid) - (SELECT COUNT(*) FROM fwd_all) AS zero_forward,
  (SELECT COUNT(*) FROM fwd_all) AS with_forward,
  (SELECT COUNT(*) FROM fwd_all WHERE fwd_row_count >= {S.min_forward_rows}) AS passing) t"""))
def q_obs_attrition(spark, d):
    return G.obs_attrition(readings_for(spark, d), S)


_TH = ", ".join(f"({t})" for t in SENSITIVITY_THRESHOLDS)


@register("forward_sensitivity", O.with_base(S, f"""
, th AS (SELECT CAST(t AS INTEGER) AS threshold FROM (VALUES {_TH}) v(t)),
tot AS (SELECT COUNT(*) AS total_grid FROM fwd_all),
per AS (
  SELECT th.threshold, COUNT(DISTINCT f.station_id) AS stations, COUNT(*) AS obs,
    SUM(f.target) AS pos, MIN(f.fwd_row_count) AS min_fwd,
    PERCENTILE_CONT(0.25) WITHIN GROUP (ORDER BY f.fwd_row_count) AS p25_fwd,
    PERCENTILE_CONT(0.50) WITHIN GROUP (ORDER BY f.fwd_row_count) AS p50_fwd,
    PERCENTILE_CONT(0.75) WITHIN GROUP (ORDER BY f.fwd_row_count) AS p75_fwd,
    MAX(f.fwd_row_count) AS max_fwd
  FROM th JOIN fwd_all f ON f.fwd_row_count >= th.threshold GROUP BY th.threshold)
SELECT th.threshold, COALESCE(per.stations, 0) AS stations, COALESCE(per.obs, 0) AS obs,
  CASE WHEN tot.total_grid > 0 THEN COALESCE(per.obs, 0)::DOUBLE / tot.total_grid * 100 ELSE 0.0 END AS pct_grid,
  CASE WHEN COALESCE(per.obs, 0) > 0 THEN per.pos::DOUBLE / per.obs * 100 ELSE 0.0 END AS pos_rate,
  per.min_fwd, per.p25_fwd, per.p50_fwd, per.p75_fwd, per.max_fwd
FROM th CROSS JOIN tot LEFT JOIN per ON per.threshold = th.threshold"""))
def q_forward_sensitivity(spark, d):
    return G.forward_sensitivity(spark, readings_for(spark, d), S)


@register("station_capacity", O.with_base(
    S, "SELECT station_id, AVG(avg_capacity) AS avg_capacity FROM readings GROUP BY station_id"))
def q_station_capacity(spark, d):
    return G.station_capacity(readings_for(spark, d))


# Inspection: the registered forms inspect every station over the whole span.
INSPECT_START = datetime(2024, 1, 1)
INSPECT_END = datetime(2024, 1, 3)


@register("inspect_dataset", O.with_dataset(S, f"""
SELECT * FROM dataset WHERE obs_ts >= TIMESTAMP '{INSPECT_START}' AND obs_ts <= TIMESTAMP '{INSPECT_END}'"""))
def q_inspect_dataset(spark, d):
    return G.inspect_dataset(D.build_dataset(readings_for(spark, d), S), None, INSPECT_START,
                             INSPECT_END)


@register("inspect_raw_around", O.with_dataset(S, """
SELECT d.station_id, d.obs_ts, r.window_start, r.avg_bikes_available, r.avg_docks_available,
  r.avg_capacity, r.avg_availability_ratio, r.window_start = d.obs_ts AS is_obs
FROM dataset d JOIN readings r ON r.station_id = d.station_id
 AND r.window_start BETWEEN d.obs_ts - INTERVAL 5 MINUTE AND d.obs_ts + INTERVAL 5 MINUTE"""))
def q_inspect_raw_around(spark, d):
    r = readings_for(spark, d)
    return G.inspect_raw_around(r, D.build_dataset(r, S), minutes=5)


_FWD_ROWS_SQL = f"""
SELECT d.station_id, d.obs_ts, r.window_start, r.avg_bikes_available, r.avg_docks_available,
  r.avg_availability_ratio, r.avg_bikes_available < {S.empty_threshold!r} AS is_low
FROM dataset d JOIN readings r ON r.station_id = d.station_id
 AND r.window_start > d.obs_ts AND r.window_start <= d.obs_ts + INTERVAL {S.label_horizon_min} MINUTE"""


@register("inspect_forward_rows", O.with_dataset(S, _FWD_ROWS_SQL))
def q_inspect_forward_rows(spark, d):
    r = readings_for(spark, d)
    return G.inspect_forward_rows(r, D.build_dataset(r, S), S)


@register("inspect_forward_trim", O.with_dataset(S, f"""
SELECT * FROM (
  SELECT f.*, row_number() OVER (PARTITION BY station_id, obs_ts ORDER BY window_start) AS row_pos,
         COUNT(*) OVER (PARTITION BY station_id, obs_ts) AS n_rows
  FROM ({_FWD_ROWS_SQL}) f) t
WHERE n_rows <= 6 OR row_pos <= 3 OR row_pos > n_rows - 3"""))
def q_inspect_forward_trim(spark, d):
    r = readings_for(spark, d)
    return G.inspect_forward_trim(G.inspect_forward_rows(r, D.build_dataset(r, S), S))

