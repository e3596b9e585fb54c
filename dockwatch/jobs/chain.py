"""Build, validate and train in one job that publishes a run only when it is complete."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockwatch.ml.model import DEFAULT_MAX_ITER
from dockwatch.ml.training import train_run
from dockwatch.plans.dataset import build_dataset
from dockwatch.reports.validation import validate_dataset
from dockwatch.settings import Settings
from dockwatch.sources.artifacts import load_dataset, run_id, write_dataset
from dockwatch.sources.runs import publish_run


def run_chain(spark: SparkSession, readings: DataFrame, root: str, s: Settings | None = None,
              max_iter: int = DEFAULT_MAX_ITER, rid: str | None = None, upstream: str = "", check=validate_dataset) -> dict:
    """Write the dataset, validate what was written, train on it and publish the run. An empty dataset or a failed validation
    (``check`` returns (ok, report)) stops the chain: ``published`` is False and no reader sees the run."""
    rid, base = rid or run_id(), root.rstrip("/")
    path = write_dataset(build_dataset(readings, s), base, spark, rid, upstream)
    if path is None:
        return {"run_ts": rid, "published": False, "reason": "empty dataset"}
    dataset = load_dataset(spark, path)
    ok, report = check(dataset)
    if not ok:
        return {"run_ts": rid, "published": False, "reason": "validation", "report": report}
    record = train_run(spark, dataset, base, max_iter, rid, path)
    row = {"run_ts": rid, "dataset": path, "model": f"{base}/model_{rid}", "metrics": f"{base}/metrics_{rid}",
           "predictions": f"{base}/test_predictions_{rid}", "row_count": dataset.count()}
    publish_run(spark, base, **row)
    return {**row, "published": True, "metrics_record": {k: v for k, v in record.items() if not k.startswith("_")}}
