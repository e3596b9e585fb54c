"""Scoring and triage queries (rule scorer: deterministic, so they have oracles)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch import oracles as O
from dockwatch.catalog import S, register
from dockwatch.functions.timeexpr import HOUR_US, MINUTE_US, floor_to, from_micros, micros
from dockwatch.ml.scorers import RuleScorer
from dockwatch.plans import scoring as R
from dockwatch.plans import triage as T
from dockwatch.settings import FEATURE_COLUMNS
from dockwatch.sources.readings import readings_for

# Fixed job parameters of the registered triage queries.
TRIAGE_TS = datetime(2024, 1, 1, 18, 0)
TRIAGE_TOP_N = 10


def derived_requests(readings: DataFrame) -> DataFrame:
    """Score requests derived from the readings: every (station, hour) at :37:30
    (between grid points), one 30 min before each station's first reading, one
    3 h after its last, and an unknown station id."""
    us = micros("window_start")
    hourly = readings.select(
        "station_id", from_micros(floor_to(us, HOUR_US) + F.lit(37 * MINUTE_US + 30_000_000))
        .alias("obs_ts"))
    g = readings.groupBy("station_id").agg(F.min("window_start").alias("lo"),
                                           F.max("window_start").alias("hi"))
    before = g.select("station_id", (F.col("lo") - F.expr("INTERVAL 30 MINUTES")).alias("obs_ts"))
    after = g.select("station_id", (F.col("hi") + F.expr("INTERVAL 3 HOURS")).alias("obs_ts"))
    unknown = g.select(F.concat("station_id", F.lit("-unknown")).alias("station_id"),
                       (F.col("lo") + F.expr("INTERVAL 60 MINUTES")).alias("obs_ts"))
    return hourly.unionByName(before).unionByName(after).unionByName(unknown).distinct()


REQ_CTE = """
, requests AS (
  SELECT DISTINCT station_id, date_trunc('hour', window_start) + INTERVAL 2250 SECOND AS obs_ts FROM readings
  UNION SELECT station_id, MIN(window_start) - INTERVAL 30 MINUTE FROM readings GROUP BY station_id
  UNION SELECT station_id, MAX(window_start) + INTERVAL 3 HOUR FROM readings GROUP BY station_id
  UNION SELECT station_id || '-unknown', MIN(window_start) + INTERVAL 60 MINUTE FROM readings GROUP BY station_id
),""" + O.point_feature_ctes("requests", S, "rq")

FEAT_LIST = ", ".join(FEATURE_COLUMNS)


def _req_sql(tail: str) -> str:
    return O.with_base(S, REQ_CTE + "\n" + tail)


@register("reconstruct_features", _req_sql(
    f"SELECT station_id, obs_ts, snapshot_source_ts, {FEAT_LIST}, status, "
    f"{O.STATUS_SQL} AS http_status FROM rq_feat"))
def q_reconstruct_features(spark, d):
    r = readings_for(spark, d)
    return R.reconstruct_features(r, derived_requests(r), S).drop("detail")


@register("request_status", _req_sql(
    f"SELECT station_id, obs_ts, status, {O.STATUS_SQL} AS http_status FROM rq_feat"))
def q_request_status(spark, d):
    r = readings_for(spark, d)
    return R.reconstruct_features(r, derived_requests(r), S).select(
        "station_id", "obs_ts", "status", "http_status")


_RULE_SCORE = "LEAST(GREATEST(1.0 - ft_bikes_available / GREATEST(m, 1.0), 0.0), 1.0)"


@register("score_requests_rule", _req_sql(f"""
, okm AS (SELECT MAX(ft_bikes_available) AS m FROM rq_feat WHERE status = 'ok')
SELECT station_id, obs_ts,
  CASE WHEN status = 'ok' THEN round({_RULE_SCORE}, 6) END AS risk_score,
  CASE WHEN status = 'ok' THEN CAST({_RULE_SCORE} >= {S.score_threshold!r} AS INTEGER) END AS risk_label,
  CASE WHEN status = 'ok' THEN {S.score_threshold!r} END AS threshold,
  snapshot_source_ts,
  CASE WHEN status = 'ok' THEN 'low_bikes_rule' END AS model_name,
  status, {O.STATUS_SQL} AS http_status
FROM rq_feat, okm""".replace("\n, okm", ",\nokm", 1)))
def q_score_requests_rule(spark, d):
    r = readings_for(spark, d)
    return R.score_requests(r, derived_requests(r), RuleScorer(), S)


# ---------------------------------------------------------------- triage

_T = f"TIMESTAMP '{TRIAGE_TS}'"
TRIAGE_CTE = f"""
, cand AS (
  SELECT DISTINCT station_id FROM readings
  WHERE avg_capacity >= {S.min_capacity!r}
    AND window_start BETWEEN {_T} - INTERVAL 15 MINUTE AND {_T}),
tpts AS (SELECT station_id, {_T} AS obs_ts FROM cand),""" + O.point_feature_ctes("tpts", S, "tr") + f""",
okm AS (SELECT MAX(ft_bikes_available) AS m FROM tr_feat WHERE status = 'ok'),
sc AS (
  SELECT f.*, round({_RULE_SCORE}, 6) AS risk_score FROM tr_feat f, okm WHERE f.status = 'ok'),
rk AS (
  SELECT CAST(row_number() OVER (ORDER BY risk_score DESC, COALESCE(ft_bikes_available, 0.0), station_id) AS INTEGER) AS rank,
    station_id, risk_score, CAST(risk_score >= {S.score_threshold!r} AS INTEGER) AS risk_label,
    ft_bikes_available AS bikes_available, ft_capacity AS capacity, snapshot_source_ts,
    ft_availability_ratio AS availability_ratio,
    round(CAST(epoch_us(obs_ts) - epoch_us(snapshot_source_ts) AS DOUBLE) / 60000000.0, 1) AS snapshot_age_min,
    ft_bikes_delta_60m AS bikes_delta_60m
  FROM sc)"""


def _tri_sql(tail: str) -> str:
    return O.with_base(S, TRIAGE_CTE + "\n" + tail)


def _triage(spark, d, debug=False):
    return T.triage(readings_for(spark, d), TRIAGE_TS, RuleScorer(), S, TRIAGE_TOP_N, debug)


@register("active_stations", _tri_sql("SELECT station_id FROM cand"))
def q_active_stations(spark, d):
    return T.active_stations(readings_for(spark, d), TRIAGE_TS, S)


@register("triage_ranked", _tri_sql(
    "SELECT rank, station_id, risk_score, risk_label, bikes_available, capacity, snapshot_source_ts "
    f"FROM rk WHERE rank <= {TRIAGE_TOP_N}"))
def q_triage_ranked(spark, d):
    return _triage(spark, d)["ranked"]


@register("triage_debug", _tri_sql(f"SELECT * FROM rk WHERE rank <= {TRIAGE_TOP_N}"))
def q_triage_debug(spark, d):
    return _triage(spark, d, debug=True)["ranked"]


@register("triage_skipped", _tri_sql(
    "SELECT station_id, status AS reason FROM tr_feat WHERE status <> 'ok'"))
def q_triage_skipped(spark, d):
    return _triage(spark, d)["skipped"]


@register("triage_skip_reasons", _tri_sql(
    "SELECT status AS reason, COUNT(*) AS stations FROM tr_feat WHERE status <> 'ok' GROUP BY status"))
def q_triage_skip_reasons(spark, d):
    return _triage(spark, d)["skip_reasons"]


@register("triage_funnel", _tri_sql(f"""
SELECT {_T} AS obs_ts, COUNT(*) AS candidate_stations,
  COUNT(*) FILTER (WHERE status = 'ok') AS scored,
  COUNT(*) FILTER (WHERE status <> 'ok') AS skipped,
  {TRIAGE_TOP_N} AS top_n, 'low_bikes_rule' AS model_name
FROM tr_feat"""))
def q_triage_funnel(spark, d):
    return _triage(spark, d)["funnel"]
