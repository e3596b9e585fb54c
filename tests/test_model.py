"""Boosted-tree model, persistence, evaluation of a saved run, streaming scoring."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dockwatch import catalog_model
from dockwatch.ml import model as GB
from dockwatch.ml.scorers import ModelScorer, RuleScorer
from dockwatch.ml.split import temporal_split
from dockwatch.ml.training import evaluate_saved, train_run
from dockwatch.plans.dataset import build_dataset
from dockwatch.plans.triage import triage_result
from dockwatch.settings import Settings
from dockwatch.streaming.score_stream import score_stream

from .conftest import BASE


def test_best_iteration_patience():
    assert GB.best_iteration([5, 4, 3, 3.5, 3.6, 3.7], patience=2) == 3
    assert GB.best_iteration([5, 4, 3, 2, 1], patience=50) == 5
    assert GB.best_iteration([1, 2, 3, 0.5], patience=2) == 1


def test_trains_until_the_patience_rule(spark, random_readings):
    sp = temporal_split(build_dataset(random_readings, Settings(min_forward_rows=30))).cache()
    train, val = sp.filter("split = 'train'"), sp.filter("split = 'val'")
    model, info = GB.train_model(train, val, patience=2)
    best, fitted = info["best_iteration"], info["fitted_rounds"]
    assert info["max_iter"] == 1000 and fitted - best >= 2 and len(info["val_losses"]) == fitted
    assert model.stages[-1].getNumTrees == best == GB.best_iteration(info["val_losses"], 2)
    refit, _ = GB.train_model(train, val.limit(0), max_iter=best)  # fitted with as many rounds
    assert refit.stages[-1].getNumTrees == best
    assert GB.feature_importance(model, None) == GB.feature_importance(refit, None)
    assert GB.predictions(model, val).exceptAll(GB.predictions(refit, val)).count() == 0


def test_registered_queries_train_the_default_rounds(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(catalog_model, "readings_for", lambda *a: None)
    monkeypatch.setattr(catalog_model.D, "build_dataset", lambda *a: None)
    monkeypatch.setattr(catalog_model.TR, "train_run", lambda *a, **k: seen.update(k) or {})
    catalog_model._run(spark, "/no/such/folder")
    assert seen.get("max_iter", GB.DEFAULT_MAX_ITER) == 1000


@pytest.fixture(scope="module")
def run(spark, random_readings, tmp_path_factory):
    ds = build_dataset(random_readings, Settings(min_forward_rows=30))
    out = str(tmp_path_factory.mktemp("runs"))
    rec = train_run(spark, ds, out, max_iter=6, rid="20240101_000000")
    return ds, out, rec


def test_training_run_artifacts(spark, run):
    ds, out, rec = run
    assert set(rec["split"]) == {"train", "val", "test"}
    assert 1 <= rec["gbt"]["best_iteration"] <= 6
    assert len(rec["gbt"]["feature_importance"]) == 22
    preds = spark.read.parquet(f"{out}/test_predictions_20240101_000000")
    assert preds.columns == ["station_id", "obs_ts", "y_true", "y_score", "y_pred"]
    assert preds.filter((F.col("y_score") < 0) | (F.col("y_score") > 1)).count() == 0
    assert set(rec["baselines"]) == {"always_negative", "low_bikes_rule_k0", "low_bikes_rule_k1"}


def test_saved_model_reproduces_metrics(spark, run):
    ds, out, _ = run
    ev = {r["metric"]: r for r in evaluate_saved(
        spark, ds, f"{out}/model_20240101_000000", f"{out}/metrics_20240101_000000").collect()}
    assert ev["f1"]["status"] == "MATCH"
    assert ev["roc_auc"]["status"] == "MATCH" or ev["roc_auc"]["saved"] is None


def test_load_missing_model_raises(tmp_path):
    with pytest.raises(FileNotFoundError):
        GB.load_model(str(tmp_path / "nope"))


def test_model_scorer_in_triage(spark, readings, run):
    _, _, rec = run
    res = triage_result(readings, datetime(2024, 6, 15, 9, 30), ModelScorer(rec["_model"]),
                        Settings())
    assert res["scored"] == 2 and len(res["stations"]) == 2
    assert all(0.0 <= s["risk_score"] <= 1.0 for s in res["stations"])


def test_streaming_scoring(spark, readings, tmp_path):
    reqs = [("S1", BASE + timedelta(minutes=m)) for m in (30, 95, 150)] + [("S9", BASE)]
    spark.createDataFrame(reqs, "station_id string, obs_ts timestamp_ntz").repartition(2).write.parquet(
        str(tmp_path / "req"))
    q = score_stream(spark, readings, str(tmp_path / "req"), str(tmp_path / "out"),
                     str(tmp_path / "ck"), RuleScorer(), Settings(), max_files_per_trigger=1)
    q.awaitTermination()
    out = {(r["station_id"], r["obs_ts"]): r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(out) == 4
    assert out[("S9", BASE)]["status"] == "station_not_found"
    assert out[("S1", BASE + timedelta(minutes=95))]["risk_label"] == 1
