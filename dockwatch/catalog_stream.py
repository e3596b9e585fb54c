"""Streaming queries. The rule's maximum is fitted once over all readings, so a row's score doesn't depend on
its micro-batch and the answers have SQL oracles."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from dockwatch import oracles as O
from dockwatch.catalog import S, register
from dockwatch.catalog_serve import REQ_CTE, derived_requests
from dockwatch.functions.timeexpr import ntz_literal
from dockwatch.ml.scorers import RuleScorer
from dockwatch.session import ensure_checkpoint_dir
from dockwatch.sources.readings import readings_for
from dockwatch.streaming.live_score import score_live
from dockwatch.streaming.score_stream import score_stream

# Fixed job parameter: readings arrive in files of this many hours, and as far out of order.
ARRIVAL_HOURS = 3

_SCORED = f"""
, rule AS (SELECT MAX(avg_bikes_available) AS m, MAX(window_start) AS newest FROM readings),
scored AS (
  SELECT q.*, newest, LEAST(GREATEST(1.0 - ft_bikes_available / GREATEST(m, 1.0), 0.0), 1.0) AS raw
  FROM rq_feat q, rule)
SELECT station_id, obs_ts,
  CASE WHEN status = 'ok' THEN round(raw, 6) END AS risk_score,
  CASE WHEN status = 'ok' THEN CAST(raw >= {S.score_threshold!r} AS INTEGER) END AS risk_label,
  CASE WHEN status = 'ok' THEN {S.score_threshold!r} END AS threshold,
  snapshot_source_ts, CASE WHEN status = 'ok' THEN 'low_bikes_rule' END AS model_name,
  status, {O.STATUS_SQL} AS http_status
FROM scored"""


def _folder(spark) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/dockwatch-stream/{uuid.uuid4().hex}"


@register("score_stream", O.with_base(S, (REQ_CTE + _SCORED).replace("\n, rule", ",\nrule", 1)))
def q_score_stream(spark, d):
    """Requests written as files, scored by a Structured Streaming query in
    micro-batches (availableNow), outputs read back."""
    base = _folder(spark)
    r = readings_for(spark, d)
    derived_requests(r).repartition(4).write.mode("overwrite").parquet(f"{base}/requests")
    q = score_stream(spark, r, f"{base}/requests", f"{base}/out", f"{base}/ckpt", RuleScorer.fitted(r), S,
                     max_files_per_trigger=2)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("epoch")


def arriving(readings, base: str, hours: int) -> None:
    """Write readings as files that arrive in the order of time, ``hours`` at a time."""
    lo, hi = readings.agg(F.min("window_start"), F.max("window_start")).first()
    while lo is not None and lo <= hi:
        end = lo + timedelta(hours=hours)
        part = readings.where((F.col("window_start") >= ntz_literal(lo)) & (F.col("window_start") < ntz_literal(end)))
        part.write.mode("append").parquet(base)
        lo = end


@register("score_live", O.with_base(S, (REQ_CTE + _SCORED).replace("\n, rule", ",\nrule", 1)
                                    + f" WHERE epoch_ms(obs_ts) + 1 < epoch_ms(newest - INTERVAL {ARRIVAL_HOURS} HOUR)"))
def q_score_live(spark, d):
    """Readings and requests both arrive as files; answered are the requests that the final watermark has passed."""
    base = _folder(spark)
    readings_for(spark, d).write.parquet(f"{base}/all")
    r = spark.read.parquet(f"{base}/all")
    arriving(r, f"{base}/readings", ARRIVAL_HOURS)
    derived_requests(r).repartition(4).write.parquet(f"{base}/requests")
    q = score_live(spark, f"{base}/readings", f"{base}/requests", f"{base}/out", f"{base}/ckpt", RuleScorer.fitted(r), S,
                   delay=f"{ARRIVAL_HOURS} hours", late_hours=48)
    q.awaitTermination()
    return spark.read.parquet(f"{base}/out").drop("epoch")
