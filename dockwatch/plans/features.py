"""One definition of the 22 features, shared by build, scoring and triage.

Every plan reduces readings to the same *parts* per (station_id, obs_ts):

* ``snap``: newest reading record at or before obs_ts (struct, NULL if none)
* ``asof_15``, ``asof_30``, ``asof_60``, ``asof_1440``: newest at or before
  obs_ts - offset minutes
* ``w60_{bsum,bcnt,bmin,bmax,rsum,rcnt}`` over [obs_ts - 60m, obs_ts]
* ``w1440_{bsum,bcnt,bmin,bmax,low,ev}`` over [obs_ts - 24h, obs_ts]

and :func:`features_from_parts` turns parts into features.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwatch.functions.nulls import safe_div
from dockwatch.functions.timeexpr import day_of_week, hour_of_day, is_weekend

# As-of offsets (minutes) and the feature each one feeds.
LAG_FEATURES = {
    15: "ft_bikes_available_lag_15m",
    30: "ft_bikes_available_lag_30m",
    60: "ft_bikes_available_lag_60m",
    1440: "ft_bikes_available_lag_24h",
}
SHORT_WINDOW_MIN = 60
LONG_WINDOW_MIN = 1440

W_SHORT = ("bsum", "bcnt", "bmin", "bmax", "rsum", "rcnt")
W_LONG = ("bsum", "bcnt", "bmin", "bmax", "low", "ev")


def feature_exprs(obs_ts: Column | None = None) -> dict[str, Column]:
    """Feature name -> expression over a parts row."""
    obs_ts = F.col("obs_ts") if obs_ts is None else obs_ts
    snap = F.col("snap")
    bikes = snap["bikes"]
    cap = snap["cap"]
    avg60 = safe_div(F.col("w60_bsum"), F.col("w60_bcnt"))
    ex = {
        "ft_bikes_available": bikes,
        "ft_docks_available": snap["docks"],
        "ft_availability_ratio": snap["ratio"],
    }
    for off, name in LAG_FEATURES.items():
        ex[name] = F.col(f"asof_{off}")["bikes"]
    ex.update({
        "ft_avg_bikes_60m": avg60,
        "ft_min_bikes_60m": F.col("w60_bmin"),
        "ft_max_bikes_60m": F.col("w60_bmax"),
        "ft_avg_ratio_60m": safe_div(F.col("w60_rsum"), F.col("w60_rcnt")),
        "ft_avg_bikes_24h": safe_div(F.col("w1440_bsum"), F.col("w1440_bcnt")),
        "ft_min_bikes_24h": F.col("w1440_bmin"),
        "ft_max_bikes_24h": F.col("w1440_bmax"),
        "ft_low_avail_freq_24h": safe_div(F.col("w1440_low"), F.col("w1440_ev")),
        "ft_hour_of_day": hour_of_day(obs_ts),
        "ft_day_of_week": day_of_week(obs_ts),
        "ft_is_weekend": is_weekend(obs_ts),
        "ft_capacity": cap,
        "ft_pct_bikes_of_capacity": safe_div(bikes, cap),
        "ft_pct_docks_of_capacity": safe_div(snap["docks"], cap),
        "ft_bikes_delta_60m": bikes - avg60,
    })
    return ex


def with_features(parts: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Append feature columns (all 22 by default) to a parts frame."""
    ex = feature_exprs()
    names = list(ex) if names is None else names
    return parts.select("*", *[ex[n].alias(n) for n in names])
