"""Training run and saved-model evaluation (orchestration over the operators)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwatch.ml import baseline as B
from dockwatch.ml import metrics as M
from dockwatch.ml import model as GB
from dockwatch.ml import split as SP
from dockwatch.settings import SEED
from dockwatch.sources import artifacts as A


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict() for r in df.collect()]


def train_run(spark: SparkSession, dataset: DataFrame, out_dir: str | None = None,
              max_iter: int = GB.DEFAULT_MAX_ITER, rid: str | None = None,
              input_path: str = "") -> dict:
    """Split, null rates, baselines, boosted trees, metrics; optionally writes
    model, test predictions and the metrics record under ``out_dir``.

    The split dataset is checkpointed once (shared checkpoint dir) and reused
    by every step."""
    rid = rid or A.run_id()
    sp = SP.temporal_split(dataset).checkpoint(eager=True)
    train = sp.filter(F.col("split") == "train")
    val = sp.filter(F.col("split") == "val")
    test = sp.filter(F.col("split") == "test")
    info = {r["split"]: {k: v for k, v in r.items() if k != "split"}
            for r in _rows(SP.split_info(sp))}
    null_rates = {r["feature"]: r["null_rate"] for r in _rows(SP.feature_null_rates(train))}
    base = M.classification_metrics(B.baseline_predictions(test))
    model, minfo = GB.train_model(train, val, max_iter=max_iter)
    pred = GB.predictions(model, test)
    gm = M.classification_metrics(pred.withColumn("model", F.lit("gbt")))
    record = {
        "run_timestamp": rid,
        "seed": SEED,
        "input_parquet": input_path,
        "split": info,
        "feature_null_rates": null_rates,
        "baselines": {r["model"]: r for r in _rows(base)},
        "gbt": {**{k: v for k, v in minfo.items() if k != "val_losses"},
                "metrics": _rows(gm)[0] if gm.count() else {},
                "feature_importance": GB.feature_importance(model, None)},
    }
    if out_dir:
        base_dir = out_dir.rstrip("/")
        GB.save_model(model, f"{base_dir}/model_{rid}")
        A.write_predictions(pred, base_dir, rid)
        A.write_metrics(spark, record, base_dir, rid)
    record["_model"] = model
    record["_test_predictions"] = pred
    return record


def evaluate_saved(spark: SparkSession, dataset: DataFrame, model_path: str,
                   metrics_path: str | None = None, tol: float = 1e-6) -> DataFrame:
    """Recompute the test-split metrics of a saved model; beside each of
    roc_auc, pr_auc and f1 the saved value and MATCH / DIFF (within tol).
    The saved record is chosen by run id (the model's own run)."""
    model = GB.load_model(model_path)
    test = SP.temporal_split(dataset).filter(F.col("split") == "test")
    m = M.classification_metrics(GB.predictions(model, test).withColumn("model", F.lit("gbt")))
    cur = _rows(m)[0]
    saved = {}
    if metrics_path:
        saved = A.read_metrics(spark, metrics_path).get("gbt", {}).get("metrics", {})
    rows = []
    for k in ("roc_auc", "pr_auc", "f1"):
        sv, cv = saved.get(k), cur.get(k)
        match = sv is not None and cv is not None and abs(sv - cv) < tol
        rows.append((k, None if sv is None else float(sv), None if cv is None else float(cv),
                     "MATCH" if match else "DIFF"))
    return spark.createDataFrame(rows, "metric string, saved double, recomputed double, status string")
