"""Feature reconstruction and request checks for arbitrary (station, timestamp)
requests, and scoring.

Plan R (requests at any instant, many at once):

1. The requests are written once (shared folder); their earliest and latest instants bound the scan of
   readings to ``[start of the day of t - 24h, t]``. Older readings are met only through the station
   look-back index (``plans.lookback``), by station and day.
2. ``bucket_rollup`` of the requested stations' readings (whole-bucket stats), and one window over those
   bucket rows with the requests placed at their own bucket: whole buckets strictly inside each frame,
   and the newest reading of any bucket before each as-of edge.
3. An equi-join of each request's *edge buckets* (the bucket of t, t-15m, t-30m, t-60m, t-24h) with the raw
   readings of those buckets only, aggregated per request: the partial-bucket pieces at both ends of every
   frame and the as-of candidates inside the edge buckets. Rollup and join read one shuffle of the
   readings by (station, bucket).
4. Combine pieces into the shared parts, then ``plans.features``.

No per-request loop and no range join: every step is an equi-join, a hash aggregate or a bucket-level
window, so a hot station is bounded by its time span, not its reading volume.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockwatch.functions.nulls import nsum
from dockwatch.functions.timeexpr import MINUTE_US, bucket_micros, from_micros, micros, ntz_literal
from dockwatch.operators.newest import key_time, newest_aggs, newest_record
from dockwatch.operators.rollup import REC_VALUES, rollup_rows, with_buckets
from dockwatch.plans.features import (
    LAG_FEATURES,
    LONG_WINDOW_MIN,
    SHORT_WINDOW_MIN,
    W_LONG,
    W_SHORT,
    feature_exprs,
)
from dockwatch.plans.lookback import day_micros, newest_before, station_days
from dockwatch.session import ensure_checkpoint_dir
from dockwatch.settings import (
    FEATURE_COLUMNS,
    STATUS_CODES,
    STATUS_NO_SCORE,
    STATUS_NOT_FOUND,
    STATUS_OK,
    STATUS_OUT_OF_DOMAIN,
    STATUS_STALE,
    Settings,
)

UNB = Window.unboundedPreceding
# Buckets of plan R (minutes): a common divisor of all as-of offsets and windows. Requests lie anywhere.
BUCKET_MIN = 15


def _combine(stat: str, *pieces: Column) -> Column:
    if stat == "bmin":
        return F.least(*pieces)
    if stat == "bmax":
        return F.greatest(*pieces)
    if stat in ("bcnt", "rcnt"):
        out = F.coalesce(pieces[0], F.lit(0))
        for p in pieces[1:]:
            out = out + F.coalesce(p, F.lit(0))
        return out
    return nsum(*pieces)


def _piece(stat: str, cond: Column) -> Column:
    src = {
        "bsum": ("sum", "avg_bikes_available"), "bcnt": ("count", "avg_bikes_available"),
        "bmin": ("min", "avg_bikes_available"), "bmax": ("max", "avg_bikes_available"),
        "rsum": ("sum", "avg_availability_ratio"), "rcnt": ("count", "avg_availability_ratio"),
        "low": ("sum", "low_availability_events"), "ev": ("sum", "event_count"),
    }[stat]
    fn = getattr(F, src[0])
    return fn(F.when(cond, F.col(src[1])))


def stored_requests(requests: DataFrame) -> DataFrame:
    """The requests, every row kept, written to the folder named by ``spark.checkpoint.dir``: each step of
    plan R reads this table, and its size in bytes is known to Spark's choice of joins."""
    spark = requests.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/requests-{uuid.uuid4().hex}"
    q = requests.select("station_id", "obs_ts", micros("obs_ts").alias("t"))
    q.write.parquet(path)
    return spark.read.schema(q.schema).parquet(path)


def _day_start(ts: datetime) -> datetime:
    return ts.replace(hour=0, minute=0, second=0, microsecond=0)


def _lag(rec: Column) -> Column:
    return F.when(rec.isNotNull(), F.struct(rec["ts"].alias("ts"), rec["bikes"].alias("bikes")))


def request_parts(readings: DataFrame, requests: DataFrame, s: Settings,
                  broadcast_requests: bool | None = None, index: DataFrame | None = None) -> DataFrame:
    """Parts for every (station_id, obs_ts) request; a request that occurs twice has two rows.

    ``index`` is the station look-back index (``plans.lookback.station_days``) over at least all days
    before the earliest request's ``t - 24h``; without one it is derived from the readings of those
    days. A request without a station or an instant finds nothing. ``broadcast_requests`` forces a
    broadcast of the requests' stations and edges; by default Spark decides by their size in bytes."""
    iv = BUCKET_MIN * MINUTE_US
    offs = sorted(LAG_FEATURES)
    wins = (SHORT_WINDOW_MIN, LONG_WINDOW_MIN)
    kept = stored_requests(requests)
    lo, hi = kept.agg(F.min("obs_ts"), F.max("obs_ts")).first()
    if lo is None:
        lo = hi = datetime(1970, 1, 1)
    longest = timedelta(minutes=LONG_WINDOW_MIN)

    q = kept.where("station_id IS NOT NULL AND obs_ts IS NOT NULL").distinct()
    q = q.withColumn("bt", bucket_micros("t", BUCKET_MIN))
    hint = F.broadcast if broadcast_requests else lambda df: df
    stations = hint(q.select("station_id").distinct())
    ws = F.col("window_start")
    near = readings.where((ws >= ntz_literal(_day_start(lo - longest))) & (ws <= ntz_literal(hi)))
    # rollup and edge join need the same columns of the same rows, so they share one shuffle
    rr = with_buckets(near.join(stations, "station_id", "left_semi"), BUCKET_MIN).select(
        "station_id", "b", "k", *REC_VALUES.values(), "low_availability_events", "event_count")
    rr = rr.where("station_id IS NOT NULL AND b IS NOT NULL").repartition("station_id", "b")

    # 2: whole buckets, windowed together with the requests
    roll = rollup_rows(rr, BUCKET_MIN, split_at_start=False).withColumn("is_req", F.lit(False))
    u = roll.unionByName(
        q.select("station_id", F.col("bt").alias("b"), "obs_ts", "t", F.lit(True).alias("is_req")),
        allowMissingColumns=True)
    w = Window.partitionBy("station_id").orderBy("b")
    full = [F.max("f_rec").over(w.rangeBetween(UNB, -1)).alias("before_0")]
    for o in offs:
        full.append(F.max("f_rec").over(w.rangeBetween(UNB, -o * MINUTE_US - 1)).alias(f"before_{o}"))
    for wmin, stats in zip(wins, (W_SHORT, W_LONG)):
        fr = w.rangeBetween(-wmin * MINUTE_US + iv, -iv)
        for st in stats:
            agg = {"bmin": F.min, "bmax": F.max}.get(st, F.sum)
            full.append(agg(f"f_{st}").over(fr).alias(f"full{wmin}_{st}"))
    full_parts = u.select("station_id", "obs_ts", "t", "is_req", *full).filter(
        F.col("is_req")).drop("is_req")

    # 3: edge buckets of each request joined to their raw readings
    edges = q.select("station_id", "obs_ts", "t", "bt",
                     F.explode(F.array(*[F.lit(o).cast("long") for o in [0, *offs]])).alias("eo"))
    edges = edges.withColumn("b", F.col("bt") - F.col("eo") * F.lit(MINUTE_US))
    ej = hint(edges).join(rr, ["station_id", "b"])
    t, eo, key = F.col("t"), F.col("eo"), F.col("k")
    ts = key_time(key, F.col("b"), iv)
    trail = (eo == 0) & (ts <= t)
    values = {n: F.col(c) for n, c in REC_VALUES.items()}
    e_aggs = newest_aggs(key, values, "edge_0", trail)
    for o in offs:
        e_aggs += newest_aggs(key, {"bikes": values["bikes"]}, f"edge_{o}", (eo == o) & (ts <= t - o * MINUTE_US))
    for st in sorted(set(W_SHORT) | set(W_LONG)):
        e_aggs.append(_piece(st, trail).alias(f"trail_{st}"))
    for wmin, stats in zip(wins, (W_SHORT, W_LONG)):
        lead = (eo == wmin) & (ts >= t - wmin * MINUTE_US)
        for st in stats:
            e_aggs.append(_piece(st, lead).alias(f"lead{wmin}_{st}"))
    edge_parts = ej.groupBy("station_id", "obs_ts", "bt").agg(*e_aggs)
    edge_parts = edge_parts.select(
        "station_id", "obs_ts", *[c for c in edge_parts.columns if c.startswith(("trail_", "lead"))],
        newest_record("edge_0", tuple(REC_VALUES), F.col("bt"), iv).alias("edge_0"),
        *[newest_record(f"edge_{o}", ("bikes",), F.col("bt") - F.lit(o * MINUTE_US), iv).alias(f"edge_{o}")
          for o in offs])

    # what no day from that of t - 24h on holds: the newest reading of the days before
    day = day_micros(F.col("t") - F.lit(LONG_WINDOW_MIN * MINUTE_US))
    if index is None:
        index = station_days(readings.where(ws < ntz_literal(_day_start(hi - longest)))
                             .join(stations, "station_id", "left_semi"))
    old = newest_before(q.select("station_id", day.alias("day")), index)

    # 4: combine; one row for each row of the requests
    j = full_parts.withColumn("day", day).join(edge_parts, ["station_id", "obs_ts"], "left")
    j = j.join(old, ["station_id", "day"], "left")
    cols = [F.greatest("edge_0", "before_0", "old").alias("snap")]
    for o in offs:
        cols.append(F.greatest(F.col(f"edge_{o}"), _lag(F.col(f"before_{o}")), _lag(F.col("old"))).alias(f"asof_{o}"))
    for wmin, stats in zip(wins, (W_SHORT, W_LONG)):
        for st in stats:
            cols.append(_combine(st, F.col(f"lead{wmin}_{st}"), F.col(f"full{wmin}_{st}"),
                                 F.col(f"trail_{st}")).alias(f"w{wmin}_{st}"))
    return kept.select("station_id", "obs_ts").join(
        j.select("station_id", "obs_ts", *cols), ["station_id", "obs_ts"], "left")


def status_columns(s: Settings, obs_us: Column | None = None) -> list[Column]:
    """Request status in check order, with code and detail; computed from parts."""
    snap = F.col("snap")
    obs_us = micros("obs_ts") if obs_us is None else obs_us
    age = obs_us - snap["ts"]
    status = (
        F.when(snap.isNull(), F.lit(STATUS_NOT_FOUND))
        .when(snap["cap"].isNotNull() & (snap["cap"] < F.lit(s.min_capacity)),
              F.lit(STATUS_OUT_OF_DOMAIN))
        .when(age > F.lit(s.max_staleness_min * MINUTE_US), F.lit(STATUS_STALE))
        .otherwise(F.lit(STATUS_OK))
    )
    code = F.create_map(*[x for k, v in STATUS_CODES.items() for x in (F.lit(k), F.lit(v))])
    detail = (
        F.when(status == STATUS_NOT_FOUND, F.format_string("station %s has no reading at or before the instant", F.col("station_id")))
        .when(status == STATUS_OUT_OF_DOMAIN,
              F.format_string(f"capacity %.1f is under the floor of {s.min_capacity}", snap["cap"]))
        .when(status == STATUS_STALE,
              F.format_string(f"newest reading is %.1f min old, allowed are {s.max_staleness_min}", age / F.lit(float(MINUTE_US))))
    )
    return [status.alias("status"), code[status].alias("http_status"), detail.alias("detail")]


def reconstruct_features(readings: DataFrame, requests: DataFrame, s: Settings | None = None,
                         broadcast_requests: bool | None = None,
                         index: DataFrame | None = None) -> DataFrame:
    """Per request: snapshot_source_ts, the 22 features (NULL where the
    request failed), status, http_status, detail."""
    s = s or Settings()
    p = request_parts(readings, requests, s, broadcast_requests, index)
    return features_and_status(p, s)


def features_and_status(p: DataFrame, s: Settings, keep: tuple[str, ...] = ()) -> DataFrame:
    """Features and request status from parts; ``keep`` names further columns to keep."""
    ex = feature_exprs()
    return p.select(
        "station_id", "obs_ts",
        from_micros(F.col("snap")["ts"]).alias("snapshot_source_ts"),
        *[ex[n].alias(n) for n in FEATURE_COLUMNS],
        *status_columns(s), *keep,
    )


def judged(scored: DataFrame) -> DataFrame:
    """Rows that passed the checks but got no score have an outcome of their own."""
    none = F.col("raw_score").isNull()
    return scored.withColumns({
        "status": F.when(none, STATUS_NO_SCORE).otherwise(F.col("status")),
        "http_status": F.when(none, STATUS_CODES[STATUS_NO_SCORE]).otherwise(F.col("http_status"))})


def score_frame(scored: DataFrame, s: Settings, model_name: str | None, more=()) -> DataFrame:
    """Response columns from rows that carry ``raw_score``: score rounded to 6
    places, label from the unrounded score."""
    return scored.select(
        "station_id", "obs_ts",
        F.round(F.col("raw_score"), 6).alias("risk_score"),
        (F.col("raw_score") >= F.lit(s.score_threshold)).cast("int").alias("risk_label"),
        F.when(F.col("raw_score").isNotNull(), F.lit(s.score_threshold)).alias("threshold"),
        "snapshot_source_ts",
        F.when(F.col("raw_score").isNotNull(), F.lit(model_name).cast("string")).alias("model_name"),
        "status", "http_status", *more,
    )


def score_requests(readings: DataFrame, requests: DataFrame, scorer, s: Settings | None = None,
                   debug: bool = False, index: DataFrame | None = None) -> DataFrame:
    """Score every request: ok rows get a risk score; others keep their status
    with NULL score. ``scorer`` maps a features frame to one with ``raw_score``."""
    s = s or Settings()
    return score_features(reconstruct_features(readings, requests, s, index=index), scorer, s, debug)


def score_features(feats: DataFrame, scorer, s: Settings, debug: bool = False) -> DataFrame:
    """Scores of rows of ``features_and_status``; ``debug`` keeps the features beside them."""
    ok = feats.filter(F.col("status") == STATUS_OK)
    scored = judged(scorer.score(ok))
    out = score_frame(scored, s, getattr(scorer, "name", None), FEATURE_COLUMNS if debug else ())
    bad = feats.filter(F.col("status") != STATUS_OK).select(
        "station_id", "obs_ts", "snapshot_source_ts", "status", "http_status")
    return out.unionByName(bad, allowMissingColumns=True)
