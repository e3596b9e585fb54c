"""Classification metrics as aggregations over prediction tables.

Inputs are long tables ``(group..., y_true, y_pred, y_score)``; every metric is
computed per group (e.g. per model) in one job.

ROC / PR AUC need cumulative counts in descending score order. A running sum
over an unpartitioned window would pull all rows into one task, so
``ranked_cumulative`` reduces to distinct scores and takes their running sums by
ranges (``operators.ranks``).

All metrics look at the same rows: those with a label, a prediction and a score. A
prediction without a score (unknown inputs) is neither right nor wrong; ``classification_metrics`` reports
their number as ``unscored``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwatch.operators.ranks import running_sums

# Output precision of the floating-point sums (PR AUC, log loss): summation
# order differs between engines, so they are reported to 12 decimals.
SUM_DECIMALS = 12
LOGLOSS_EPS = 1e-15


def is_scored() -> Column:
    """Rows that metrics look at."""
    return F.col("y_true").isNotNull() & F.col("y_pred").isNotNull() & F.col("y_score").isNotNull()


def confusion_metrics(pred: DataFrame, group: Sequence[str] = ("model",)) -> DataFrame:
    """tp, fp, tn, fn, accuracy, precision, recall, f1 (0 when undefined)."""
    yt, yp = F.col("y_true"), F.col("y_pred")
    g = pred.where(is_scored()).groupBy(*group).agg(
        F.count(F.when((yt == 1) & (yp == 1), 1)).alias("tp"),
        F.count(F.when((yt == 0) & (yp == 1), 1)).alias("fp"),
        F.count(F.when((yt == 0) & (yp == 0), 1)).alias("tn"),
        F.count(F.when((yt == 1) & (yp == 0), 1)).alias("fn"),
        F.count(F.lit(1)).alias("n"),
    )

    def ratio(num, den):
        return F.coalesce(num.cast("double") / F.nullif(den, F.lit(0)).cast("double"), F.lit(0.0))

    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return g.select(
        *group, "tp", "fp", "tn", "fn",
        ratio(tp + tn, F.col("n")).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def ranked_cumulative(pred: DataFrame, group: Sequence[str] = ("model",),
                      n_ranges: int | None = None) -> DataFrame:
    """Per (group, distinct score): pos, neg and the positives / negatives with a
    strictly higher score (``pos_above``, ``neg_above``)."""
    group = list(group)
    d = pred.where(is_scored()).groupBy(*group, "y_score").agg(
        F.sum(F.when(F.col("y_true") == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col("y_true") == 1, 0).otherwise(1)).cast("long").alias("neg"),
    )
    d = running_sums(d, "y_score", ["pos", "neg"], group, descending=True, ranges=n_ranges)
    return d.select(*group, "y_score", "pos", "neg", F.col("pos_before").alias("pos_above"),
                    F.col("neg_before").alias("neg_above"))


def auc_metrics(pred: DataFrame, group: Sequence[str] = ("model",),
                n_ranges: int | None = None) -> DataFrame:
    """ROC AUC (ties count one half) and PR AUC (trapezoid over the PR curve
    that starts at recall 0, precision 1). NULL when one class only or when
    every score is 0."""
    group = list(group)
    c = ranked_cumulative(pred, group, n_ranges)
    tp = F.col("pos_above") + F.col("pos")
    fp = F.col("neg_above") + F.col("neg")
    prec = tp.cast("double") / (tp + fp).cast("double")
    prev_den = F.col("pos_above") + F.col("neg_above")
    prev_prec = F.when(prev_den > 0, F.col("pos_above").cast("double") / prev_den.cast("double")
                       ).otherwise(F.lit(1.0))
    a = c.groupBy(*group).agg(
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
        F.max("y_score").alias("max_score"),
        F.sum(F.col("neg").cast("decimal(38,0)")
              * (F.lit(2) * F.col("pos_above") + F.col("pos")).cast("decimal(38,0)"))
        .alias("roc_num"),
        F.sum(F.col("pos").cast("double") * (prec + prev_prec)).alias("pr_num"),
    )
    ok = (F.col("P") > 0) & (F.col("N") > 0) & (F.col("max_score") > 0)
    roc = F.col("roc_num").cast("double") / (F.lit(2.0) * F.col("P").cast("double")
                                            * F.col("N").cast("double"))
    pr = F.col("pr_num") / (F.lit(2.0) * F.col("P").cast("double"))
    return a.select(*group, F.when(ok, roc).alias("roc_auc"),
                    F.when(ok, F.round(pr, SUM_DECIMALS)).alias("pr_auc"))


def log_loss(pred: DataFrame, group: Sequence[str] = ("model",)) -> DataFrame:
    """Mean binary cross-entropy with scores clipped to [1e-15, 1 - 1e-15];
    NULL when only one class is present."""
    p = F.least(F.greatest(F.col("y_score"), F.lit(LOGLOSS_EPS)), F.lit(1 - LOGLOSS_EPS))
    y = F.col("y_true").cast("double")
    term = -(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p))
    a = pred.where(is_scored()).groupBy(*group).agg(
        F.avg(term).alias("ll"),
        F.countDistinct("y_true").alias("k"),
    )
    return a.select(*group, F.when(F.col("k") > 1, F.round(F.col("ll"), SUM_DECIMALS))
                    .alias("log_loss"))


def classification_metrics(pred: DataFrame, group: Sequence[str] = ("model",)) -> DataFrame:
    """All metrics per group: confusion counts, accuracy, precision, recall, f1,
    roc_auc, pr_auc, log_loss over the scored rows, and the number of ``unscored`` ones. A group without any
    scored row has NULL metrics."""
    group = list(group)
    left_out = pred.groupBy(*group).agg(F.count(F.when(~is_scored(), 1)).alias("unscored"))
    return (left_out.join(confusion_metrics(pred, group), group, "left")
            .join(auc_metrics(pred, group), group, "left").join(log_loss(pred, group), group, "left")
            .select(*group, "tp", "fp", "tn", "fn", "accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "log_loss",
                    "unscored"))


def metrics_long(metrics: DataFrame, group: Sequence[str] = ("model",)) -> DataFrame:
    """(group..., metric, value) for the comparison table."""
    names = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "log_loss"]
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return metrics.selectExpr(*group, f"stack({len(names)}, {pairs}) AS (metric, value)")


def comparison_table(metrics: DataFrame, group: str = "model") -> DataFrame:
    """Metric rows x model columns (the side-by-side table)."""
    long = metrics_long(metrics, [group])
    models = [r[0] for r in metrics.select(group).distinct().orderBy(group).collect()]
    return long.groupBy("metric").pivot(group, models).agg(F.first("value"))
