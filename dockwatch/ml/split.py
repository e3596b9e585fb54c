"""Temporal train / validation / test split over the obs_ts range."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwatch.functions.nulls import is_missing
from dockwatch.functions.timeexpr import from_micros, micros
from dockwatch.settings import FEATURE_COLUMNS, SPLIT_TRAIN_END, SPLIT_VAL_END, TARGET_COLUMN

SPLITS = ("train", "val", "test")


def split_bounds(dataset: DataFrame) -> DataFrame:
    """One row: ts_min, ts_max, split_ts_val = min + 0.70 (max - min),
    split_ts_test = min + 0.85 (max - min); durations in micros, truncated."""
    a = dataset.agg(micros(F.min("obs_ts")).alias("lo"), micros(F.max("obs_ts")).alias("hi"))
    dur = (F.col("hi") - F.col("lo")).cast("double")
    return a.select(
        from_micros("lo").alias("ts_min"),
        from_micros("hi").alias("ts_max"),
        from_micros(F.col("lo") + F.floor(dur * SPLIT_TRAIN_END).cast("long")).alias("split_ts_val"),
        from_micros(F.col("lo") + F.floor(dur * SPLIT_VAL_END).cast("long")).alias("split_ts_test"),
    )


def temporal_split(dataset: DataFrame) -> DataFrame:
    """Dataset rows with a ``split`` column: train < t_val <= val < t_test <= test.
    All rows of one obs_ts land in one split by construction. The one-row
    bounds table is broadcast (size fixed at one row)."""
    b = F.broadcast(split_bounds(dataset).select("split_ts_val", "split_ts_test"))
    j = dataset.crossJoin(b)
    split = (F.when(F.col("obs_ts") < F.col("split_ts_val"), "train")
             .when(F.col("obs_ts") < F.col("split_ts_test"), "val").otherwise("test"))
    return j.withColumn("split", split).drop("split_ts_val", "split_ts_test")


def split_info(split_df: DataFrame) -> DataFrame:
    """Per split: start, end, rows, positive rate (0.0 for an empty split)."""
    spark = split_df.sparkSession
    names = spark.createDataFrame([(s,) for s in SPLITS], "split string")
    agg = split_df.groupBy("split").agg(
        F.min("obs_ts").alias("start"), F.max("obs_ts").alias("end"),
        F.count(F.lit(1)).alias("rows"), F.avg(TARGET_COLUMN).alias("rate"))
    out = F.broadcast(names).join(agg, "split", "left")
    return out.select(
        "split", "start", "end", F.coalesce(F.col("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.col("rate"), F.lit(0.0)).alias("positive_rate"))


def split_overlap(split_df: DataFrame) -> DataFrame:
    """obs_ts values present in more than one split (must be empty)."""
    return (split_df.groupBy("obs_ts").agg(F.countDistinct("split").alias("n_splits"))
            .filter(F.col("n_splits") > 1))


def feature_null_rates(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """(feature, null_rate) for the model features: one aggregate, unpivoted."""
    feats = features or FEATURE_COLUMNS
    dtypes = dict(df.dtypes)
    agg = df.agg(*[
        F.avg((is_missing(F.col(c)) if dtypes[c] in ("double", "float") else F.col(c).isNull())
              .cast("int")).alias(c) for c in feats])
    pairs = ", ".join(f"'{c}', `{c}`" for c in feats)
    long = agg.selectExpr(f"stack({len(feats)}, {pairs}) AS (feature, null_rate)")
    return long.select("feature", F.coalesce(F.col("null_rate"), F.lit(0.0)).alias("null_rate"))


def high_null_features(null_rates: DataFrame, threshold: float = 0.5) -> DataFrame:
    return null_rates.filter(F.col("null_rate") > threshold).orderBy(F.desc("null_rate"))


def class_balance(train: DataFrame) -> DataFrame:
    """n_pos, n_neg and the positive class weight n_neg / max(n_pos, 1)."""
    t = F.col(TARGET_COLUMN)
    a = train.agg(F.count(F.when(t == 1, 1)).alias("n_pos"), F.count(F.lit(1)).alias("n"))
    return a.select(
        "n_pos", (F.col("n") - F.col("n_pos")).alias("n_neg"),
        ((F.col("n") - F.col("n_pos")).cast("double")
         / F.greatest(F.col("n_pos"), F.lit(1)).cast("double")).alias("scale_pos_weight"))


def splits(spark: SparkSession, dataset: DataFrame) -> dict[str, DataFrame]:
    s = temporal_split(dataset)
    return {name: s.filter(F.col("split") == name).drop("split") for name in SPLITS}
