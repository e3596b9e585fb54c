"""Queries around the boosted-tree model (no SQL oracle: the trees are fitted by MLlib; the driver
checks rows only)."""

from __future__ import annotations

from dockwatch.catalog import S, register
from dockwatch.catalog_serve import TRIAGE_TOP_N, TRIAGE_TS, derived_requests
from dockwatch.ml import training as TR
from dockwatch.ml.scorers import ModelScorer
from dockwatch.plans import dataset as D
from dockwatch.plans import scoring as R
from dockwatch.plans import triage as T
from dockwatch.session import ensure_checkpoint_dir
from dockwatch.sources.readings import readings_for

_RUNS: dict[str, dict] = {}


def _run(spark, d):
    """One training run per input folder and Spark application, shared by the queries."""
    key = f"{spark.sparkContext.applicationId}:{d}"
    if key not in _RUNS:
        ds = D.build_dataset(readings_for(spark, d), S)
        out = ensure_checkpoint_dir(spark).rstrip("/") + "/dockwatch-runs"
        _RUNS[key] = TR.train_run(spark, ds, out, input_path=d)
        _RUNS[key]["_out"] = out
    return _RUNS[key]


@register("train_model")
def q_train_model(spark, d):
    """Test-split predictions of the fitted model (the saved predictions table)."""
    return _run(spark, d)["_test_predictions"]


@register("test_predictions")
def q_test_predictions(spark, d):
    run = _run(spark, d)
    return spark.read.parquet(f"{run['_out']}/test_predictions_{run['run_timestamp']}")


@register("feature_importance")
def q_feature_importance(spark, d):
    rows = _run(spark, d)["gbt"]["feature_importance"][:10]
    return spark.createDataFrame([(r["feature"], r["importance"]) for r in rows],
                                 "feature string, importance double")


@register("evaluate_model")
def q_evaluate_model(spark, d):
    run = _run(spark, d)
    ds = D.build_dataset(readings_for(spark, d), S)
    return TR.evaluate_saved(spark, ds, f"{run['_out']}/model_{run['run_timestamp']}",
                             f"{run['_out']}/metrics_{run['run_timestamp']}")


@register("score_requests")
def q_score_requests(spark, d):
    r = readings_for(spark, d)
    return R.score_requests(r, derived_requests(r), ModelScorer(_run(spark, d)["_model"]), S,
                            debug=True)


@register("triage_model")
def q_triage_model(spark, d):
    out = T.triage(readings_for(spark, d), TRIAGE_TS, ModelScorer(_run(spark, d)["_model"]), S,
                   TRIAGE_TOP_N)
    return out["ranked"]
