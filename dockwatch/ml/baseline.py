"""Baseline scorers: always-negative and the low-bikes rule."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.settings import LOW_BIKES_THRESHOLDS, TARGET_COLUMN

PRED_COLS = ["station_id", "obs_ts", "y_true", "y_pred", "y_score"]


def always_negative(df: DataFrame) -> DataFrame:
    return df.select(
        "station_id", "obs_ts", F.col(TARGET_COLUMN).alias("y_true"),
        F.lit(0).alias("y_pred"), F.lit(0.0).alias("y_score"),
    ).withColumn("model", F.lit("always_negative"))


def low_bikes_score(bikes, max_bikes):
    """clip(1 - bikes / max(max_bikes, 1), 0, 1): fewer bikes, higher risk. Unknown bikes have no score."""
    score = F.lit(1.0) - bikes / F.greatest(max_bikes, F.lit(1.0))
    return F.when(bikes.isNotNull(), F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)))


def low_bikes_rule(df: DataFrame, k: int) -> DataFrame:
    """Predict 1 when bikes <= k; score relative to the largest bike count among
    the rows scored (a one-row global aggregate, broadcast)."""
    mx = F.broadcast(df.agg(F.max("ft_bikes_available").alias("__max_bikes")))
    j = df.crossJoin(mx)
    bikes = F.col("ft_bikes_available")
    return j.select(
        "station_id", "obs_ts", F.col(TARGET_COLUMN).alias("y_true"),
        F.coalesce((bikes <= F.lit(float(k))).cast("int"), F.lit(0)).alias("y_pred"),
        low_bikes_score(bikes, F.col("__max_bikes")).alias("y_score"),
    ).withColumn("model", F.lit(f"low_bikes_rule_k{k}"))


def baseline_predictions(test: DataFrame, ks=LOW_BIKES_THRESHOLDS) -> DataFrame:
    """All baselines stacked: (model, station_id, obs_ts, y_true, y_pred, y_score)."""
    out = always_negative(test)
    for k in ks:
        out = out.unionByName(low_bikes_rule(test, k))
    return out.select("model", *PRED_COLS)
