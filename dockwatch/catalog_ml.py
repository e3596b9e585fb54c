"""Training-side queries: split, null rates, class balance, baselines, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockwatch import oracles as O
from dockwatch.catalog import S, register
from dockwatch.ml import baseline as B
from dockwatch.ml import metrics as M
from dockwatch.ml import split as SP
from dockwatch.plans import dataset as D
from dockwatch.settings import FEATURE_COLUMNS, SPLIT_TRAIN_END, SPLIT_VAL_END
from dockwatch.sources.readings import readings_for


def _dataset(spark, d):
    return D.build_dataset(readings_for(spark, d), S)


def _split(spark, d):
    return SP.temporal_split(_dataset(spark, d))


def _test_preds(spark, d):
    test = _split(spark, d).filter(F.col("split") == "test")
    return B.baseline_predictions(test)


SPLIT_CTES = f"""
, bounds AS (
  SELECT MIN(obs_ts) AS ts_min, MAX(obs_ts) AS ts_max,
         epoch_us(MIN(obs_ts)) AS lo_us, epoch_us(MAX(obs_ts)) AS hi_us FROM dataset),
b2 AS (
  SELECT ts_min, ts_max,
    make_timestamp(lo_us + CAST(floor(CAST(hi_us - lo_us AS DOUBLE) * {SPLIT_TRAIN_END!r}) AS BIGINT)) AS split_ts_val,
    make_timestamp(lo_us + CAST(floor(CAST(hi_us - lo_us AS DOUBLE) * {SPLIT_VAL_END!r}) AS BIGINT)) AS split_ts_test
  FROM bounds),
splitted AS (
  SELECT d.*, CASE WHEN d.obs_ts < b.split_ts_val THEN 'train'
                   WHEN d.obs_ts < b.split_ts_test THEN 'val' ELSE 'test' END AS split
  FROM dataset d CROSS JOIN b2 b),
test AS (SELECT * FROM splitted WHERE split = 'test'),
train AS (SELECT * FROM splitted WHERE split = 'train'),
mx AS (SELECT MAX(ft_bikes_available) AS m FROM test),
preds AS (
  SELECT 'always_negative' AS model, station_id, obs_ts, target_empty_next_hour AS y_true,
         0 AS y_pred, CAST(0.0 AS DOUBLE) AS y_score FROM test
  UNION ALL
  SELECT 'low_bikes_rule_k0', station_id, obs_ts, target_empty_next_hour,
         COALESCE(CAST(ft_bikes_available <= 0.0 AS INTEGER), 0),
         LEAST(GREATEST(1.0 - ft_bikes_available / GREATEST(m, 1.0), 0.0), 1.0) FROM test, mx
  UNION ALL
  SELECT 'low_bikes_rule_k1', station_id, obs_ts, target_empty_next_hour,
         COALESCE(CAST(ft_bikes_available <= 1.0 AS INTEGER), 0),
         LEAST(GREATEST(1.0 - ft_bikes_available / GREATEST(m, 1.0), 0.0), 1.0) FROM test, mx),
conf AS (
  SELECT model,
    COUNT(*) FILTER (WHERE y_true = 1 AND y_pred = 1) AS tp,
    COUNT(*) FILTER (WHERE y_true = 0 AND y_pred = 1) AS fp,
    COUNT(*) FILTER (WHERE y_true = 0 AND y_pred = 0) AS tn,
    COUNT(*) FILTER (WHERE y_true = 1 AND y_pred = 0) AS fn,
    COUNT(*) AS n
  FROM preds WHERE y_score IS NOT NULL GROUP BY model),
conf_m AS (
  SELECT model, tp, fp, tn, fn,
    COALESCE(CAST(tp + tn AS DOUBLE) / CAST(NULLIF(n, 0) AS DOUBLE), 0.0) AS accuracy,
    COALESCE(CAST(tp AS DOUBLE) / CAST(NULLIF(tp + fp, 0) AS DOUBLE), 0.0) AS precision,
    COALESCE(CAST(tp AS DOUBLE) / CAST(NULLIF(tp + fn, 0) AS DOUBLE), 0.0) AS recall,
    COALESCE(CAST(2 * tp AS DOUBLE) / CAST(NULLIF(2 * tp + fp + fn, 0) AS DOUBLE), 0.0) AS f1
  FROM conf),
g AS (
  SELECT model, y_score,
    CAST(SUM(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
    CAST(SUM(CASE WHEN y_true = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg
  FROM preds WHERE y_score IS NOT NULL GROUP BY model, y_score),
c AS (
  SELECT *, COALESCE(SUM(pos) OVER w, 0) AS pos_above, COALESCE(SUM(neg) OVER w, 0) AS neg_above
  FROM g WINDOW w AS (PARTITION BY model ORDER BY y_score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
a AS (
  SELECT model, SUM(pos) AS P, SUM(neg) AS N, MAX(y_score) AS mxs,
    SUM(CAST(neg AS HUGEINT) * (2 * pos_above + pos)) AS roc_num,
    SUM(CAST(pos AS DOUBLE) * (CAST(pos_above + pos AS DOUBLE) / CAST(pos_above + pos + neg_above + neg AS DOUBLE)
        + CASE WHEN pos_above + neg_above > 0 THEN CAST(pos_above AS DOUBLE) / CAST(pos_above + neg_above AS DOUBLE) ELSE 1.0 END)) AS pr_num
  FROM c GROUP BY model),
auc AS (
  SELECT model,
    CASE WHEN P > 0 AND N > 0 AND mxs > 0 THEN CAST(roc_num AS DOUBLE) / (2.0 * CAST(P AS DOUBLE) * CAST(N AS DOUBLE)) END AS roc_auc,
    CASE WHEN P > 0 AND N > 0 AND mxs > 0 THEN round(pr_num / (2.0 * CAST(P AS DOUBLE)), 12) END AS pr_auc
  FROM a),
ll AS (
  SELECT model,
    CASE WHEN COUNT(DISTINCT y_true) > 1 THEN round(AVG(-(CAST(y_true AS DOUBLE) * ln(LEAST(GREATEST(y_score, 1e-15), 1 - 1e-15))
      + (1.0 - CAST(y_true AS DOUBLE)) * ln(1.0 - LEAST(GREATEST(y_score, 1e-15), 1 - 1e-15)))), 12) END AS log_loss
  FROM preds WHERE y_score IS NOT NULL GROUP BY model),
allm AS (
  SELECT m.*, a.roc_auc, a.pr_auc, l.log_loss FROM conf_m m
  LEFT JOIN auc a ON a.model = m.model LEFT JOIN ll l ON l.model = m.model)
"""


def _ml_sql(tail: str) -> str:
    return O.with_dataset(S, SPLIT_CTES + tail)


@register("split_bounds", _ml_sql("SELECT * FROM b2"))
def q_split_bounds(spark, d):
    return SP.split_bounds(_dataset(spark, d))


@register("temporal_split", _ml_sql(
    "SELECT station_id, obs_ts, target_empty_next_hour, split FROM splitted"))
def q_temporal_split(spark, d):
    return _split(spark, d).select("station_id", "obs_ts", "target_empty_next_hour", "split")


@register("split_info", _ml_sql("""
SELECT s.split, t.start, t."end", COALESCE(t.rows, 0) AS rows, COALESCE(t.rate, 0.0) AS positive_rate
FROM (VALUES ('train'), ('val'), ('test')) s(split)
LEFT JOIN (SELECT split, MIN(obs_ts) AS start, MAX(obs_ts) AS "end", COUNT(*) AS rows,
                  AVG(target_empty_next_hour) AS rate FROM splitted GROUP BY split) t
  ON t.split = s.split"""))
def q_split_info(spark, d):
    return SP.split_info(_split(spark, d))


@register("split_overlap", _ml_sql("""
SELECT obs_ts, COUNT(DISTINCT split) AS n_splits FROM splitted GROUP BY obs_ts
HAVING COUNT(DISTINCT split) > 1"""))
def q_split_overlap(spark, d):
    return SP.split_overlap(_split(spark, d))


def _null_rate_sql(where: str = "") -> str:
    parts = []
    for c in FEATURE_COLUMNS:
        isnan = "" if c in ("ft_hour_of_day", "ft_day_of_week", "ft_is_weekend") else f" OR isnan({c})"
        parts.append(f"SELECT '{c}' AS feature, COALESCE(AVG(CASE WHEN {c} IS NULL{isnan} "
                     f"THEN 1 ELSE 0 END), 0.0) AS null_rate FROM train")
    body = "\nUNION ALL ".join(parts)
    return f"SELECT * FROM ({body}) t {where}"


@register("feature_null_rates", _ml_sql(_null_rate_sql()))
def q_feature_null_rates(spark, d):
    train = _split(spark, d).filter(F.col("split") == "train")
    return SP.feature_null_rates(train)


@register("high_null_features", _ml_sql(_null_rate_sql("WHERE null_rate > 0.5")))
def q_high_null_features(spark, d):
    train = _split(spark, d).filter(F.col("split") == "train")
    return SP.high_null_features(SP.feature_null_rates(train))


@register("class_balance", _ml_sql("""
SELECT COUNT(*) FILTER (WHERE target_empty_next_hour = 1) AS n_pos,
       COUNT(*) - COUNT(*) FILTER (WHERE target_empty_next_hour = 1) AS n_neg,
       CAST(COUNT(*) - COUNT(*) FILTER (WHERE target_empty_next_hour = 1) AS DOUBLE)
         / CAST(GREATEST(COUNT(*) FILTER (WHERE target_empty_next_hour = 1), 1) AS DOUBLE) AS scale_pos_weight
FROM train"""))
def q_class_balance(spark, d):
    train = _split(spark, d).filter(F.col("split") == "train")
    return SP.class_balance(train)


@register("baseline_always_negative", _ml_sql(
    "SELECT station_id, obs_ts, y_true, y_pred, y_score FROM preds WHERE model = 'always_negative'"))
def q_baseline_always_negative(spark, d):
    test = _split(spark, d).filter(F.col("split") == "test")
    return B.always_negative(test).select(*B.PRED_COLS)


@register("baseline_low_bikes", _ml_sql(
    "SELECT model, station_id, obs_ts, y_true, y_pred, y_score FROM preds WHERE model <> 'always_negative'"))
def q_baseline_low_bikes(spark, d):
    test = _split(spark, d).filter(F.col("split") == "test")
    out = B.low_bikes_rule(test, 0).unionByName(B.low_bikes_rule(test, 1))
    return out.select("model", *B.PRED_COLS)


@register("classification_metrics", _ml_sql(
    "SELECT model, tp, fp, tn, fn, accuracy, precision, recall, f1 FROM conf_m"))
def q_classification_metrics(spark, d):
    return M.confusion_metrics(_test_preds(spark, d))


@register("roc_auc", _ml_sql("SELECT model, roc_auc FROM auc"))
def q_roc_auc(spark, d):
    return M.auc_metrics(_test_preds(spark, d)).select("model", "roc_auc")


@register("pr_auc", _ml_sql("SELECT model, pr_auc FROM auc"))
def q_pr_auc(spark, d):
    return M.auc_metrics(_test_preds(spark, d)).select("model", "pr_auc")


@register("log_loss", _ml_sql("SELECT model, log_loss FROM ll"))
def q_log_loss(spark, d):
    return M.log_loss(_test_preds(spark, d))


@register("baseline_comparison", _ml_sql("""
SELECT model, metric, value FROM allm
UNPIVOT INCLUDE NULLS (value FOR metric IN (accuracy, precision, recall, f1, roc_auc, pr_auc, log_loss))"""))
def q_baseline_comparison(spark, d):
    return M.metrics_long(M.classification_metrics(_test_preds(spark, d)))
