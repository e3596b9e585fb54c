"""Sinks and sources of built artifacts: dataset with its summary, predictions,
metrics records, run discovery.

Each run writes into its own timestamped directory, so "latest" is the
maximum run id, not a file modification time.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwatch.reports.validation import dataset_summary

#: Partition column of a written dataset; readers don't see it.
DAY = "obs_date"
#: The column whose field metadata carries the summary in every file's footer.
SUMMARY_COLUMN = "obs_ts"
SUMMARY_SCHEMA = ("row_count long, positive_count long, station_count long, obs_ts_min timestamp_ntz, obs_ts_max timestamp_ntz, "
                  "positive_rate double")


def run_id(now: datetime | None = None) -> str:
    now = now or datetime.now(timezone.utc)
    return f"{now:%Y%m%d_%H%M%S_%f}_{uuid.uuid4().hex[:8]}"  # runs of one second stay apart


def write_dataset(dataset: DataFrame, out_dir: str, spark: SparkSession | None = None,
                  rid: str | None = None, upstream: str = "") -> str | None:
    """Write ``{out_dir}/training_dataset_{rid}`` as snappy Parquet, partitioned by day and ordered by
    (obs_ts, station_id) throughout; a day of many rows is several files. The summary is field metadata in the footers. Nothing
    is written for an empty dataset (returns None).

    The dataset is first materialised with ``checkpoint()`` (shared checkpoint
    dir), so the summary and the write do not recompute the build and a lost
    executor only re-runs from the checkpoint."""
    rid = rid or run_id()
    spark = spark or dataset.sparkSession
    ds = dataset.checkpoint(eager=True)
    summary = dataset_summary(ds).withColumn("build_timestamp", F.lit(rid)).withColumn(
        "upstream_path", F.lit(upstream))
    row = summary.first()
    if row is None or row["row_count"] == 0:
        return None
    path = f"{out_dir.rstrip('/')}/training_dataset_{rid}"
    told = json.loads(json.dumps(row.asDict(), default=lambda t: t.isoformat()))
    named = F.col(SUMMARY_COLUMN).alias(SUMMARY_COLUMN, metadata={"summary": told})
    out = ds.select(*(named if c == SUMMARY_COLUMN else c for c in ds.columns), F.to_date("obs_ts").alias(DAY))
    (out.orderBy(DAY, "obs_ts", "station_id").write.mode("overwrite").partitionBy(DAY)
     .option("compression", "snappy").parquet(path))
    return path


def load_dataset(spark: SparkSession, path: str, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """A written dataset; with ``start`` or ``end`` only the partitions of the days from one to the other are listed (whole days:
    filter the instants on top)."""
    d = spark.read.parquet(path)
    if DAY in d.columns:
        if start is not None:
            d = d.filter(F.col(DAY) >= F.lit(start.date()))
        if end is not None:
            d = d.filter(F.col(DAY) <= F.lit(end.date()))
    return d.drop(DAY)


def read_summary(spark: SparkSession, dataset_path: str) -> dict:
    """The summary from the schema in a footer; no row is read."""
    said = dict(spark.read.parquet(dataset_path).schema[SUMMARY_COLUMN].metadata["summary"])
    return said | {c: datetime.fromisoformat(said[c]) for c in ("obs_ts_min", "obs_ts_max")}


def written_summary(spark: SparkSession, dataset_path: str) -> DataFrame:
    """``dataset_summary`` of a written dataset, from its footers."""
    said = read_summary(spark, dataset_path)
    return spark.createDataFrame([tuple(said[c.split()[0]] for c in SUMMARY_SCHEMA.split(", "))], SUMMARY_SCHEMA)


def write_predictions(pred: DataFrame, out_dir: str, rid: str) -> str:
    """(station_id, obs_ts, y_true, y_score, y_pred) of the test split."""
    path = f"{out_dir.rstrip('/')}/test_predictions_{rid}"
    pred.select("station_id", "obs_ts", "y_true", "y_score", "y_pred").write.mode(
        "overwrite").option("compression", "snappy").parquet(path)
    return path


def write_metrics(spark: SparkSession, record: dict, out_dir: str, rid: str) -> str:
    """The run's metrics record (small, built on the driver from aggregates) as
    one JSON document."""
    path = f"{out_dir.rstrip('/')}/metrics_{rid}"
    doc = json.dumps(record, default=str)
    spark.createDataFrame([(rid, doc)], "run_ts string, record string").coalesce(1).write.mode(
        "overwrite").json(path)
    return path


def read_metrics(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.json(path).first()["record"])


def latest_run(paths: list[str], prefix: str) -> str | None:
    """Newest artifact by run id in its name (``{prefix}{YYYYmmdd_HHMMSS}``)."""
    cands = sorted(p for p in paths if p.rstrip("/").split("/")[-1].startswith(prefix))
    return cands[-1] if cands else None
