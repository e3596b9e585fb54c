"""Boosted-tree model on MLlib: training with validation-based early stopping,
scoring, persistence, feature importance, evaluation of a saved model.

MLlib trees have no missing-value branch, so NULL / NaN features are replaced
by one sentinel below every feature's range, identically in training and
scoring (``model_input``).
"""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.settings import FEATURE_COLUMNS, SEED, TARGET_COLUMN

MISSING_SENTINEL = -1.0e6
# Tree settings (learning rate, leaves ~ depth 5, min leaf size, row and
# feature sampling) and the early-stopping patience.
GBT_PARAMS = dict(stepSize=0.05, maxDepth=5, minInstancesPerNode=20, subsamplingRate=0.8,
                  featureSubsetStrategy="0.8", seed=SEED, checkpointInterval=10, maxBins=64)
EARLY_STOPPING_ROUNDS = 50
DEFAULT_MAX_ITER = 1000


def model_input(df: DataFrame) -> DataFrame:
    """Features with NULL / NaN replaced by the sentinel (double)."""
    cols = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")),
                       F.lit(MISSING_SENTINEL)).alias(f"__in_{c}") for c in FEATURE_COLUMNS]
    return df.select("*", *cols)


def _assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=[f"__in_{c}" for c in FEATURE_COLUMNS],
                           outputCol="features", handleInvalid="keep")


def _weighted(train: DataFrame) -> tuple[DataFrame, float]:
    """Label and class weight column: positives weigh n_neg / max(n_pos, 1)."""
    t = F.col(TARGET_COLUMN)
    row = train.agg(F.count(F.when(t == 1, 1)).alias("p"), F.count(F.lit(1)).alias("n")).first()
    spw = (row["n"] - row["p"]) / max(row["p"], 1)
    out = train.withColumn("label", t.cast("double")).withColumn(
        "weight", F.when(t == 1, F.lit(float(spw))).otherwise(F.lit(1.0)))
    return out, spw


def best_iteration(losses: list[float], patience: int = EARLY_STOPPING_ROUNDS) -> int:
    """1-based round with the lowest validation loss, stopping once ``patience``
    rounds pass without improvement."""
    best_i, best = 0, float("inf")
    for i, v in enumerate(losses):
        if v < best:
            best_i, best = i, v
        elif i - best_i >= patience:
            break
    return best_i + 1


def first_rounds(model: PipelineModel, rounds: int) -> PipelineModel:
    """The fitted model cut to its first ``rounds`` trees (no refit)."""
    gbt = model.stages[-1]
    java = gbt._java_obj
    gateway = SparkContext._active_spark_context._gateway
    ml = gateway.jvm.org.apache.spark.ml
    trees, weights = java.trees(), java.treeWeights()
    t = gateway.new_array(ml.regression.DecisionTreeRegressionModel, rounds)
    w = gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        t[i], w[i] = trees[i], weights[i]
    cut = GBTClassificationModel(ml.classification.GBTClassificationModel(
        java.uid(), t, w, java.numFeatures(), java.numClasses()))
    return PipelineModel([*model.stages[:-1], gbt._copyValues(cut, {gbt.maxIter: rounds})])


def train_model(train: DataFrame, val: DataFrame, max_iter: int = DEFAULT_MAX_ITER,
                patience: int = EARLY_STOPPING_ROUNDS) -> tuple[PipelineModel, dict]:
    """Fit in growing blocks of rounds until the validation loss has not improved for
    ``patience`` rounds or ``max_iter`` rounds are fitted; keep the trees up to the best round.

    MLlib can't go on from fitted trees, so a block fits all rounds anew, twice as many as the
    one before (same seed: the same trees first). Without validation rows: ``max_iter`` rounds."""
    tr, spw = _weighted(model_input(train))
    tr = tr.cache()
    params = dict(GBT_PARAMS, labelCol="label", weightCol="weight", featuresCol="features")
    va = model_input(val).withColumn("label", F.col(TARGET_COLUMN).cast("double")).withColumn(
        "weight", F.lit(1.0)).cache()
    checked = va.limit(1).count() > 0
    rounds = min(2 * patience, max_iter) if checked else max_iter
    losses: list[float] = []
    while True:
        model = Pipeline(stages=[_assembler(), GBTClassifier(maxIter=rounds, **params)]).fit(tr)
        if not checked:
            best = rounds
            break
        losses = list(model.stages[-1].evaluateEachIteration(model.stages[0].transform(va)))
        best = best_iteration(losses, patience)
        if rounds >= max_iter or rounds - best >= patience:
            break
        rounds = min(2 * rounds, max_iter)
    if best < rounds:
        model = first_rounds(model, best)
    tr.unpersist()
    va.unpersist()
    info = {"scale_pos_weight": spw, "best_iteration": best, "early_stopped": best < max_iter,
            "max_iter": max_iter, "fitted_rounds": rounds, "val_losses": losses,
            "hyperparams": GBT_PARAMS}
    return model, info


def predict_proba(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Input rows plus ``raw_score`` = P(target = 1)."""
    out = model.transform(model_input(df))
    keep = df.columns
    return out.select(*keep, vector_to_array("probability")[1].alias("raw_score"))


def predictions(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(station_id, obs_ts, y_true, y_score, y_pred) for a labelled split."""
    p = predict_proba(model, df)
    return p.select("station_id", "obs_ts", F.col(TARGET_COLUMN).alias("y_true"),
                    F.col("raw_score").alias("y_score"),
                    (F.col("raw_score") >= threshold).cast("int").alias("y_pred"))


def feature_importance(model: PipelineModel, top_n: int | None = 10) -> list[dict]:
    """Per-feature importance from the fitted trees (normalised to sum 1; 22
    values on the driver), sorted descending."""
    imp = model.stages[-1].featureImportances.toArray()
    rows = sorted(({"feature": f, "importance": float(v)} for f, v in zip(FEATURE_COLUMNS, imp)),
                  key=lambda r: -r["importance"])
    return rows[:top_n] if top_n else rows


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """Load a saved model; raises FileNotFoundError when nothing is there."""
    try:
        return PipelineModel.load(path)
    except Exception as e:  # Spark raises an analysis / IO error for a missing path
        raise FileNotFoundError(f"Model not found: {path}") from e
