"""DuckDB SQL oracles for the registered queries.

Each oracle starts from the same ``readings`` CTE over the driver's ``events``
view (the adapter of ``sources.readings``). All features of a point ``(station_id, obs_ts)`` come from one aggregate
over the station's readings up to it: ``arg_max`` of the whole reading for the point-in-time values, filtered
aggregates for the windows. Column names and types match the Spark queries.
"""

from __future__ import annotations

from dockwatch.plans.features import LAG_FEATURES
from dockwatch.settings import DATASET_COLUMNS, Settings
from dockwatch.sources.readings import READINGS_ORACLE_CTE


def _f(x: float) -> str:
    return repr(float(x))


TEMPORAL_SELECT = """
    CAST(EXTRACT(HOUR FROM {t}) AS INTEGER) AS ft_hour_of_day,
    CAST(EXTRACT(DOW FROM {t}) AS INTEGER) AS ft_day_of_week,
    CAST(CASE WHEN EXTRACT(DOW FROM {t}) IN (0, 6) THEN 1 ELSE 0 END AS INTEGER) AS ft_is_weekend"""


def _hour(expr: str) -> str:
    """An aggregate over the last hour."""
    return f"{expr} FILTER (r.window_start >= q.obs_ts - INTERVAL 60 MINUTE)"


def _day(expr: str) -> str:
    return f"{expr} FILTER (r.window_start >= q.obs_ts - INTERVAL 24 HOUR)"


def point_feature_ctes(points: str, s: Settings, p: str = "pt") -> str:
    """CTEs ``{p}_past`` (one aggregate per point) and ``{p}_feat`` (features and status) for the
    (station_id, obs_ts) rows of CTE ``points``."""
    bikes, ratio = "r.avg_bikes_available", "r.avg_availability_ratio"
    newest = "arg_max(r, r.window_start)"
    past = [f"{newest} AS last_seen"]
    past += [f"{newest} FILTER (r.window_start <= q.obs_ts - INTERVAL {o} MINUTE) AS ago_{o}" for o in LAG_FEATURES]
    past += [f"{_hour(f'{fn}({bikes})')} AS ft_{fn}_bikes_60m" for fn in ("avg", "min", "max")]
    past += [f"{_day(f'{fn}({bikes})')} AS ft_{fn}_bikes_24h" for fn in ("avg", "min", "max")]
    past += [f"{_hour(f'avg({ratio})')} AS ft_avg_ratio_60m",
             f"CAST({_day('sum(r.low_availability_events)')} AS DOUBLE) / NULLIF({_day('sum(r.event_count)')}, 0) "
             "AS ft_low_avail_freq_24h"]
    lags = ", ".join(f"ago_{o}.avg_bikes_available AS {name}" for o, name in LAG_FEATURES.items())
    late = s.max_staleness_min * 60_000_000
    return f"""
{p}_past AS (
  SELECT q.station_id, q.obs_ts, {", ".join(past)}
  FROM {points} q LEFT JOIN readings r ON r.station_id = q.station_id AND r.window_start <= q.obs_ts
  GROUP BY ALL),
{p}_feat AS (
  SELECT * EXCLUDE (last_seen, {", ".join(f"ago_{o}" for o in LAG_FEATURES)}),
    last_seen.window_start AS snapshot_source_ts, last_seen.avg_bikes_available AS ft_bikes_available,
    last_seen.avg_docks_available AS ft_docks_available, last_seen.avg_availability_ratio AS ft_availability_ratio,
    last_seen.avg_capacity AS ft_capacity, {lags},{TEMPORAL_SELECT.format(t="obs_ts")},
    ft_bikes_available / NULLIF(ft_capacity, 0) AS ft_pct_bikes_of_capacity,
    ft_docks_available / NULLIF(ft_capacity, 0) AS ft_pct_docks_of_capacity,
    ft_bikes_available - ft_avg_bikes_60m AS ft_bikes_delta_60m,
    CASE WHEN last_seen.window_start IS NULL THEN 'station_not_found'
         WHEN ft_capacity < {_f(s.min_capacity)} THEN 'out_of_domain'
         WHEN epoch_us(obs_ts) - epoch_us(last_seen.window_start) > {late}::BIGINT THEN 'stale_data'
         ELSE 'ok' END AS status
  FROM {p}_past)"""


def base_ctes(s: Settings) -> str:
    """readings, grid, grid_feat and views of it, fwd_all, fwd CTEs (no leading WITH)."""
    return f"""{READINGS_ORACLE_CTE},
grid AS (
  SELECT DISTINCT station_id, time_bucket(INTERVAL '{s.sample_interval_min} minutes', window_start) AS obs_ts
  FROM readings WHERE avg_capacity >= {_f(s.min_capacity)}
),{point_feature_ctes("grid", s, "grid")},
snap AS (
  SELECT station_id, obs_ts, snapshot_source_ts, ft_bikes_available, ft_docks_available, ft_availability_ratio, ft_capacity
  FROM grid_feat WHERE snapshot_source_ts IS NOT NULL
),
roll AS (SELECT station_id, obs_ts, COLUMNS('_(60m|24h)$') FROM grid_feat),
ahead AS (
  SELECT q.station_id, q.obs_ts, COUNT(r.window_start) AS fwd_row_count,
         CAST(COALESCE(MIN(r.avg_bikes_available) < {_f(s.empty_threshold)}, false) AS INTEGER) AS target
  FROM grid q LEFT JOIN readings r ON r.station_id = q.station_id
    AND epoch_us(r.window_start) - epoch_us(q.obs_ts) BETWEEN 1 AND {s.label_horizon_min * 60_000_000}::BIGINT
  GROUP BY ALL
),
fwd_all AS (SELECT * FROM ahead WHERE fwd_row_count > 0),
fwd AS (
  SELECT station_id, obs_ts, obs_ts + INTERVAL {s.label_horizon_min} MINUTE AS label_window_end,
         target AS target_empty_next_hour, fwd_row_count
  FROM fwd_all WHERE fwd_row_count >= {s.min_forward_rows}
)"""


def dataset_cte(s: Settings) -> str:
    """``dataset`` CTE with the 27 columns (needs base_ctes)."""
    return f"""
dataset AS (
  SELECT {", ".join(DATASET_COLUMNS)}
  FROM (SELECT *, obs_ts AS feature_cutoff_ts FROM grid_feat WHERE snapshot_source_ts IS NOT NULL)
  JOIN fwd USING (station_id, obs_ts)
)"""


def with_dataset(s: Settings, tail: str) -> str:
    return f"WITH {base_ctes(s)},{dataset_cte(s)}\n{tail}"


def with_base(s: Settings, tail: str) -> str:
    return f"WITH {base_ctes(s)}\n{tail}"


STATUS_SQL = """CAST(CASE status WHEN 'ok' THEN 200 WHEN 'station_not_found' THEN 404
  WHEN 'no_snapshot' THEN 404 ELSE 422 END AS INTEGER)"""
