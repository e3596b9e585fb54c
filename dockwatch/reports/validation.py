"""Validation of a built dataset as tables (check, value, passed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.settings import DATASET_COLUMNS, NULLABLE_COLUMNS, TARGET_COLUMN

KEYS = ["station_id", "obs_ts"]


def dataset_summary(dataset: DataFrame) -> DataFrame:
    """Row count, positives, distinct stations, time range: one aggregate."""
    t = F.col(TARGET_COLUMN)
    return dataset.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count(F.when(t == 1, 1)).alias("positive_count"),
        F.countDistinct("station_id").alias("station_count"),
        F.min("obs_ts").alias("obs_ts_min"),
        F.max("obs_ts").alias("obs_ts_max"),
    ).withColumn(
        "positive_rate",
        F.when(F.col("row_count") > 0, F.col("positive_count") / F.col("row_count"))
        .otherwise(F.lit(0.0)),
    )


def validation_summary(dataset: DataFrame) -> DataFrame:
    """Hard checks D3, D5, D6 next to the D2/D4 info, one row."""
    t = F.col(TARGET_COLUMN)
    base = dataset_summary(dataset)
    checks = dataset.agg(
        F.count(F.when(t.isNotNull() & ~t.isin(0, 1), 1)).alias("non_binary_targets"),
        F.count(F.when(~F.coalesce(F.col("feature_cutoff_ts") == F.col("obs_ts"), F.lit(False)), 1))
        .alias("cutoff_mismatches"),
    )
    dups = dataset.groupBy(*KEYS).count().agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("duplicate_keys"))
    out = base.crossJoin(checks).crossJoin(dups)
    rate = F.col("positive_rate")
    return out.select(
        "row_count", "station_count", "obs_ts_min", "obs_ts_max", "positive_count",
        "positive_rate", "non_binary_targets", "duplicate_keys", "cutoff_mismatches",
        ((rate < 0.01) | (rate > 0.50)).alias("positive_rate_warning"),
    )


def _is_null(df: DataFrame, c: str):
    dt = dict(df.dtypes)[c]
    col = F.col(c)
    return (col.isNull() | F.isnan(col)) if dt in ("double", "float") else col.isNull()


def validation_null_rates(dataset: DataFrame) -> DataFrame:
    """Per column: null percentage and severity (ok / WARN if nullable / FAIL).
    One aggregate of all columns, then unpivoted."""
    cols = [c for c in DATASET_COLUMNS if c in dataset.columns]
    agg = dataset.agg(*[
        (F.avg(_is_null(dataset, c).cast("int")) * 100).alias(c) for c in cols
    ])
    pairs = ", ".join(f"'{c}', `{c}`" for c in cols)
    long = agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, null_pct)")
    nullable = F.col("column_name").isin(*sorted(NULLABLE_COLUMNS))
    return long.select(
        "column_name",
        F.coalesce(F.col("null_pct"), F.lit(0.0)).alias("null_pct"),
        nullable.alias("nullable"),
        F.when(F.coalesce(F.col("null_pct"), F.lit(0.0)) == 0, "ok")
        .when(nullable, "WARN").otherwise("FAIL").alias("severity"),
    )


def validate_dataset(dataset: DataFrame) -> tuple[bool, dict]:
    """Run all checks; returns (passed, report). Only one summary row and 27
    null-rate rows reach the driver."""
    schema_ok = list(dataset.columns) == DATASET_COLUMNS
    summary = validation_summary(dataset).first().asDict()
    nulls = [r.asDict() for r in validation_null_rates(dataset).collect()] if schema_ok else []
    passed = (
        schema_ok
        and summary["non_binary_targets"] == 0
        and summary["duplicate_keys"] == 0
        and summary["cutoff_mismatches"] == 0
        and all(r["severity"] != "FAIL" for r in nulls)
    )
    return passed, {"schema_ok": schema_ok, "summary": summary, "null_rates": nulls}


def dataset_sample(dataset: DataFrame, n: int = 5, seed: int = 42) -> DataFrame:
    """Deterministic sample of n rows: smallest hash of the key with a seed
    (TakeOrderedAndProject, no full sort)."""
    return dataset.orderBy(F.xxhash64("station_id", "obs_ts", F.lit(seed))).limit(n)
