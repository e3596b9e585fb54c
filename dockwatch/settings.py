"""Run settings and fixed column vocabularies.

Everything that must equal the original pipeline's definitions for results to
match lives here, stated plainly.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Settings:
    """Knobs shared by every operator (one definition for build, scoring, triage)."""

    sample_interval_min: int = 15
    min_forward_rows: int = 30
    min_capacity: float = 5.0
    empty_threshold: float = 1.0
    label_horizon_min: int = 60
    max_staleness_min: int = 15
    score_threshold: float = 0.5
    output_dir: str = "./output"
    # Lags are as-of look-ups at obs_ts - offset, in minutes.
    lag_offsets_min: tuple[int, ...] = field(default=(15, 30, 60, 1440))

    @classmethod
    def from_env(cls, prefix: str = "DOCKWATCH_", **overrides) -> Settings:
        """Read overrides from environment variables such as DOCKWATCH_MIN_CAPACITY."""
        base = cls()
        values = {}
        for name in ("sample_interval_min", "min_forward_rows", "label_horizon_min",
                     "max_staleness_min"):
            raw = os.environ.get(prefix + name.upper())
            if raw is not None:
                values[name] = int(raw)
        for name in ("min_capacity", "empty_threshold", "score_threshold"):
            raw = os.environ.get(prefix + name.upper())
            if raw is not None:
                values[name] = float(raw)
        raw = os.environ.get(prefix + "OUTPUT_DIR")
        if raw is not None:
            values["output_dir"] = raw
        values.update(overrides)
        return replace(base, **values)

    def with_(self, **kw) -> Settings:
        return replace(self, **kw)


# --- Fixed values (must equal the original pipeline) -------------------------

# The 22 model features, in the model's canonical order.
FEATURE_COLUMNS = [
    "ft_bikes_available",
    "ft_docks_available",
    "ft_availability_ratio",
    "ft_bikes_available_lag_15m",
    "ft_bikes_available_lag_30m",
    "ft_bikes_available_lag_60m",
    "ft_bikes_available_lag_24h",
    "ft_avg_bikes_60m",
    "ft_min_bikes_60m",
    "ft_max_bikes_60m",
    "ft_avg_ratio_60m",
    "ft_avg_bikes_24h",
    "ft_min_bikes_24h",
    "ft_max_bikes_24h",
    "ft_low_avail_freq_24h",
    "ft_hour_of_day",
    "ft_day_of_week",
    "ft_is_weekend",
    "ft_capacity",
    "ft_pct_bikes_of_capacity",
    "ft_pct_docks_of_capacity",
    "ft_bikes_delta_60m",
]

TARGET_COLUMN = "target_empty_next_hour"

METADATA_COLUMNS = ["station_id", "obs_ts", "feature_cutoff_ts", "label_window_end"]

# The 27 dataset columns, in the dataset's order (differs from FEATURE_COLUMNS:
# the 60-minute ratio comes after the 24-hour block here).
DATASET_COLUMNS = [
    "station_id",
    "obs_ts",
    "feature_cutoff_ts",
    "label_window_end",
    "target_empty_next_hour",
    "ft_bikes_available",
    "ft_docks_available",
    "ft_availability_ratio",
    "ft_bikes_available_lag_15m",
    "ft_bikes_available_lag_30m",
    "ft_bikes_available_lag_60m",
    "ft_bikes_available_lag_24h",
    "ft_avg_bikes_60m",
    "ft_min_bikes_60m",
    "ft_max_bikes_60m",
    "ft_avg_bikes_24h",
    "ft_min_bikes_24h",
    "ft_max_bikes_24h",
    "ft_avg_ratio_60m",
    "ft_low_avail_freq_24h",
    "ft_hour_of_day",
    "ft_day_of_week",
    "ft_is_weekend",
    "ft_capacity",
    "ft_pct_bikes_of_capacity",
    "ft_pct_docks_of_capacity",
    "ft_bikes_delta_60m",
]

# Dataset columns allowed to hold NULLs (warn, not fail, in validation).
NULLABLE_COLUMNS = {
    "ft_availability_ratio",
    "ft_bikes_available_lag_15m",
    "ft_bikes_available_lag_30m",
    "ft_bikes_available_lag_60m",
    "ft_bikes_available_lag_24h",
    "ft_avg_bikes_60m",
    "ft_min_bikes_60m",
    "ft_max_bikes_60m",
    "ft_avg_bikes_24h",
    "ft_min_bikes_24h",
    "ft_max_bikes_24h",
    "ft_avg_ratio_60m",
    "ft_low_avail_freq_24h",
    "ft_bikes_delta_60m",
    "ft_pct_bikes_of_capacity",
    "ft_pct_docks_of_capacity",
}

SEED = 42
# Cumulative breakpoints of the temporal split over the obs_ts range.
SPLIT_TRAIN_END = 0.70
SPLIT_VAL_END = 0.85
# Low-bikes rule baselines: predict 1 when bikes <= k.
LOW_BIKES_THRESHOLDS = [0, 1]
DEFAULT_TOP_N = 10
MAX_TOP_N = 50
SENSITIVITY_THRESHOLDS = [10, 20, 30, 40, 50]
METRIC_NAMES = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "log_loss"]

# Request statuses, in the order they are checked, with HTTP-style codes.
STATUS_OK = "ok"
STATUS_NOT_FOUND = "station_not_found"
STATUS_NO_SNAPSHOT = "no_snapshot"  # kept in the vocabulary; an inner as-of never yields it
STATUS_OUT_OF_DOMAIN = "out_of_domain"
STATUS_STALE = "stale_data"
STATUS_NO_SCORE = "no_score"  # the checks passed, but the scorer has no score for such inputs
STATUS_CODES = {
    STATUS_OK: 200,
    STATUS_NOT_FOUND: 404,
    STATUS_NO_SNAPSHOT: 404,
    STATUS_OUT_OF_DOMAIN: 422,
    STATUS_STALE: 422,
    STATUS_NO_SCORE: 422,
}
