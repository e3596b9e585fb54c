"""Triage: score every active station at one instant, rank, report skips.

Plan C: one pass over the readings of ``[start of the day of t - 24h, t]`` (pushed to the scan). They are
rolled up to 15-minute buckets counted from ``t`` (one hash aggregate with partial aggregation before the
shuffle, so a hot station costs a few rows per map task), and a second, small aggregate by station puts
the candidate flag, the as-of records and the window statistics together. Older readings are met through the
station look-back index, a row per station and day. Output is one row per station; the per-station query
loop of a single-machine design disappears. Nothing is cached and no job runs before the result is read.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockwatch.functions.timeexpr import MINUTE_US, from_micros, ntz_literal, ts_literal_micros
from dockwatch.operators.rollup import bucket_rollup
from dockwatch.plans.features import (
    LAG_FEATURES,
    LONG_WINDOW_MIN,
    SHORT_WINDOW_MIN,
    W_LONG,
    W_SHORT,
    feature_exprs,
)
from dockwatch.plans.lookback import newest_before, station_days
from dockwatch.plans.scoring import judged, score_frame, status_columns
from dockwatch.settings import DEFAULT_TOP_N, FEATURE_COLUMNS, MAX_TOP_N, STATUS_OK, Settings

ACTIVE_LOOKBACK_MIN = 15
# Buckets counted from t (minutes): a common divisor of all offsets and windows.
BUCKET_MIN = 15


class TriageError(Exception):
    def __init__(self, code: str, detail: str, status: int):
        super().__init__(detail)
        self.code, self.detail, self.status = code, detail, status


def active_stations(readings: DataFrame, obs_ts: datetime, s: Settings) -> DataFrame:
    """Stations with a qualifying reading in [t - 15m, t], ordered."""
    t = ntz_literal(obs_ts)
    lo = ntz_literal(obs_ts) - F.expr(f"INTERVAL {ACTIVE_LOOKBACK_MIN} MINUTES")
    return (readings.filter((F.col("avg_capacity") >= F.lit(s.min_capacity))
                            & F.col("window_start").between(lo, t))
            .select("station_id").distinct().orderBy("station_id"))


def instant_parts(readings: DataFrame, obs_ts: datetime, s: Settings,
                  lookback_min: int | None = 0, index: DataFrame | None = None) -> DataFrame:
    """Per station with a reading in the scanned range: candidate flag and parts.

    ``index`` is the station look-back index over at least all days before that of ``t - 24h``; without one it
    is derived from the readings of those days. ``lookback_min`` more minutes of readings are scanned before the
    windows; ``None`` scans all history in one pass, without an index."""
    ws = F.col("window_start")
    if lookback_min is None:
        return _instant_aggs(readings.where(ws <= ntz_literal(obs_ts)), obs_ts, s)
    first = obs_ts - timedelta(minutes=LONG_WINDOW_MIN + lookback_min)
    day = first.replace(hour=0, minute=0, second=0, microsecond=0)
    parts = _instant_aggs(readings.where((ws <= ntz_literal(obs_ts)) & (ws >= ntz_literal(day))), obs_ts, s)
    if index is None:
        index = station_days(readings.where(ws < ntz_literal(day)))
    asked = parts.where("candidate = 1").select("station_id", F.lit(ts_literal_micros(day)).alias("day"))
    j = parts.join(newest_before(asked, index).drop("day"), "station_id", "left")
    rec_cols = ["snap"] + [f"asof_{o}" for o in LAG_FEATURES]
    return j.select(*[F.greatest(c, "old").alias(c) if c in rec_cols else F.col(c) for c in parts.columns])


def _instant_aggs(readings: DataFrame, obs_ts: datetime, s: Settings) -> DataFrame:
    t = ts_literal_micros(obs_ts)
    b, at = F.col("b"), F.col("b") == F.lit(t)
    # the active range [t - 15m, t] is the bucket before t and the rows at t
    roll = bucket_rollup(readings, BUCKET_MIN, s.min_capacity, split_at_start=True, origin_us=t)
    aggs = [
        F.max(F.when(b >= F.lit(t - ACTIVE_LOOKBACK_MIN * MINUTE_US), F.col("cap_ok")).otherwise(0)).alias("candidate"),
    ]
    for o, name in [(0, "snap"), *((o, f"asof_{o}") for o in LAG_FEATURES)]:
        edge = F.lit(t - o * MINUTE_US)
        aggs.append(F.max(F.when(b < edge, F.col("f_rec")).when(b == edge, F.col("s_rec"))).alias(name))
    for wmin, stats in ((SHORT_WINDOW_MIN, W_SHORT), (LONG_WINDOW_MIN, W_LONG)):
        inside = (b >= F.lit(t - wmin * MINUTE_US)) & (b < F.lit(t))
        for st in stats:
            fn = {"bmin": F.min, "bmax": F.max}.get(st, F.sum)
            aggs.append(fn(F.when(inside, F.col(f"f_{st}")).when(at, F.col(f"s_{st}"))).alias(f"w{wmin}_{st}"))
    g = roll.groupBy("station_id").agg(*aggs)
    counts = [f"w{SHORT_WINDOW_MIN}_bcnt", f"w{SHORT_WINDOW_MIN}_rcnt", f"w{LONG_WINDOW_MIN}_bcnt"]
    return g.select(*[F.coalesce(c, F.lit(0)).alias(c) if c in counts else F.col(c) for c in g.columns],
                    ntz_literal(obs_ts).alias("obs_ts"))


def candidate_features(readings: DataFrame, obs_ts: datetime, s: Settings,
                       lookback_min: int | None = 0, index: DataFrame | None = None) -> DataFrame:
    """Candidates with features, snapshot_source_ts and status."""
    p = instant_parts(readings, obs_ts, s, lookback_min, index).filter(F.col("candidate") == 1)
    ex = feature_exprs()
    return p.select(
        "station_id", "obs_ts",
        from_micros(F.col("snap")["ts"]).alias("snapshot_source_ts"),
        *[ex[n].alias(n) for n in FEATURE_COLUMNS],
        *status_columns(s, F.lit(ts_literal_micros(obs_ts))),
    )


def _check_top_n(top_n: int) -> None:
    if not 1 <= top_n <= MAX_TOP_N:
        raise ValueError(f"top_n must be within 1..{MAX_TOP_N}, got {top_n}")


def triage(readings: DataFrame, obs_ts: datetime, scorer, s: Settings | None = None,
           top_n: int = DEFAULT_TOP_N, debug: bool = False,
           index: DataFrame | None = None) -> dict[str, DataFrame]:
    """Ranked shortlist, skipped stations, skip-reason counts and the funnel.

    Scores are rounded to 6 places first; label and rank use the rounded score.
    Rank order: risk desc, bikes asc (NULL as 0), station_id asc; ranks are
    unique. The ranking is a TakeOrderedAndProject of top_n rows."""
    s = s or Settings()
    _check_top_n(top_n)
    cand = candidate_features(readings, obs_ts, s, index=index)
    ok = cand.filter(F.col("status") == STATUS_OK)
    tried = judged(scorer.score(ok)).withColumn("risk_score", F.round(F.col("raw_score"), 6))
    scored = tried.filter(F.col("status") == STATUS_OK)
    outcome = cand.filter(F.col("status") != STATUS_OK).select("station_id", "status").unionByName(
        tried.select("station_id", "status"))
    order = [F.desc("risk_score"), F.coalesce(F.col("ft_bikes_available"), F.lit(0.0)),
             F.asc("station_id")]
    top = scored.orderBy(*order).limit(top_n)
    ranked = top.select(
        F.row_number().over(Window.orderBy(*order)).alias("rank"),
        "station_id", "risk_score",
        (F.col("risk_score") >= F.lit(s.score_threshold)).cast("int").alias("risk_label"),
        F.col("ft_bikes_available").alias("bikes_available"),
        F.col("ft_capacity").alias("capacity"),
        "snapshot_source_ts",
        F.col("ft_availability_ratio").alias("availability_ratio"),
        F.round(F.timestamp_diff("MICROSECOND", F.col("snapshot_source_ts"), F.col("obs_ts"))
                / F.lit(float(MINUTE_US)), 1).alias("snapshot_age_min"),
        F.col("ft_bikes_delta_60m").alias("bikes_delta_60m"),
    )
    if not debug:
        ranked = ranked.drop("availability_ratio", "snapshot_age_min", "bikes_delta_60m")
    skipped = outcome.filter(F.col("status") != STATUS_OK).select(
        "station_id", F.col("status").alias("reason"))
    reasons = skipped.groupBy("reason").agg(F.count(F.lit(1)).alias("stations")).orderBy("reason")
    funnel = outcome.agg(
        F.count(F.lit(1)).alias("candidate_stations"),
        F.count(F.when(F.col("status") == STATUS_OK, 1)).alias("scored"),
        F.count(F.when(F.col("status") != STATUS_OK, 1)).alias("skipped"),
    ).select(ntz_literal(obs_ts).alias("obs_ts"), "candidate_stations", "scored",
             "skipped", F.lit(top_n).alias("top_n"),
             F.lit(getattr(scorer, "name", None)).cast("string").alias("model_name"))
    return {"ranked": ranked, "skipped": skipped, "skip_reasons": reasons, "funnel": funnel,
            "scored": score_frame(scored, s, getattr(scorer, "name", None))}


def triage_result(readings: DataFrame, obs_ts: datetime, scorer, s: Settings | None = None,
                  top_n: int = DEFAULT_TOP_N, debug: bool = False, index: DataFrame | None = None) -> dict:
    """Job-boundary form: collects the (bounded) results and raises
    ``no_active_stations`` when nothing qualifies. All-skipped is a valid, empty
    shortlist."""
    out = triage(readings, obs_ts, scorer, s, top_n, debug, index)
    funnel = out["funnel"].first().asDict()
    if funnel["candidate_stations"] == 0:
        raise TriageError("no_active_stations", f"nothing to rank: no station reported within {ACTIVE_LOOKBACK_MIN} min before {obs_ts}", 404)
    funnel["stations"] = [r.asDict() for r in out["ranked"].collect()]  # <= top_n rows
    funnel["skip_reasons"] = {r["reason"]: r["stations"] for r in out["skip_reasons"].collect()}
    funnel["skipped_stations"] = out["skipped"]  # a DataFrame: one row per skipped station
    return funnel
