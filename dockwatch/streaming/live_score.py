"""Continuous scoring from two streams: readings and requests, joined by state.

Each station has a state: its readings of the last 24 hours (and of the time requests may be late), the newest
reading before them, and the requests that wait. A request at ``t`` is answered once the watermark of the
readings has passed ``t``, that is, when all readings up to ``t`` have arrived; an event-time timer wakes the
station then. So the answers depend on the data alone, not on how files fall into micro-batches, and no
micro-batch reads history: it reads its own new rows and the states they touch.

A state is bounded by time, not by history: readings older than the horizon are dropped but for the newest one,
because as-of look-ups reach back without bound. The function only cuts windows out of the state's
rows (the *parts* of ``plans.features``); features, statuses and scores are the same Spark expressions that
batch scoring uses.

Output is written per epoch with overwrite, so a replayed epoch after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dockwatch.functions.timeexpr import HOUR_US, MINUTE_US, from_micros, micros
from dockwatch.plans.features import (
    LAG_FEATURES,
    LONG_WINDOW_MIN,
    SHORT_WINDOW_MIN,
    W_LONG,
    W_SHORT,
)
from dockwatch.plans.scoring import features_and_status, score_features
from dockwatch.settings import Settings
from dockwatch.sources.readings import READINGS_SCHEMA
from dockwatch.streaming.score_stream import REQUEST_SCHEMA

STATUS_EXPIRED = "request_expired"
EXPIRED_CODE = 422
VALUES = {
    "bikes": "avg_bikes_available", "docks": "avg_docks_available", "cap": "avg_capacity",
    "ratio": "avg_availability_ratio", "low": "low_availability_events", "ev": "event_count",
}
#: A reading in the state; unknown values are NaN, a missing emission is the oldest.
READING = np.dtype([("ts", "<i8"), ("em", "<i8"), *((n, "<f8") for n in VALUES)])
NO_EMISSION = np.iinfo(np.int64).min
STATE = "readings binary, older binary, waiting binary"

RECORD = ("ts", "bikes", "docks", "ratio", "cap")
WINDOWS = ((SHORT_WINDOW_MIN, W_SHORT), (LONG_WINDOW_MIN, W_LONG))
OUTPUT = [*(f"snap_{n}" for n in RECORD), *(f"lag_{o}" for o in LAG_FEATURES), *(f"w{w}_{s}" for w, stats in WINDOWS for s in stats)]
ANSWER = "station_id string, t long, expired boolean, " + ", ".join(f"{c} double" for c in OUTPUT)
COUNTS = ("bcnt", "rcnt", "low", "ev")


def _window_stats(rows: np.ndarray, stats: tuple[str, ...]) -> list[float]:
    """Sums are NaN without a known value, like SQL's NULL."""
    bikes, ratio = rows["bikes"][~np.isnan(rows["bikes"])], rows["ratio"][~np.isnan(rows["ratio"])]
    low, ev = (rows[c][~np.isnan(rows[c])] for c in ("low", "ev"))
    total = lambda x: x.sum() if len(x) else np.nan
    out = {
        "bsum": total(bikes), "bcnt": len(bikes), "bmin": bikes.min(initial=np.inf), "bmax": bikes.max(initial=-np.inf),
        "rsum": total(ratio), "rcnt": len(ratio), "low": total(low), "ev": total(ev),
    }
    if not len(bikes):
        out["bmin"] = out["bmax"] = np.nan
    return [float(out[s]) for s in stats]


def parts_at(rows: np.ndarray, older: np.ndarray, t: int) -> list[float]:
    """``OUTPUT`` at ``t`` from a station's readings (sorted by time, then emission) and the newest reading before
    them (an array of one or none)."""

    def newest(at: int):
        k = int(np.searchsorted(rows["ts"], at, "right"))
        return rows[k - 1] if k else older[0] if len(older) else None

    snap = newest(t)
    out = [np.nan if snap is None else float(snap[n]) for n in RECORD]
    for o in LAG_FEATURES:
        rec = newest(t - o * MINUTE_US)
        out.append(np.nan if rec is None else float(rec["bikes"]))
    to = int(np.searchsorted(rows["ts"], t, "right"))
    for w, stats in WINDOWS:
        out += _window_stats(rows[int(np.searchsorted(rows["ts"], t - w * MINUTE_US)):to], stats)
    return out


def _sorted(rows: np.ndarray) -> np.ndarray:
    return rows[np.lexsort((rows["em"], rows["ts"]))]


def _arrived(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """New readings, and the instants of new requests."""
    got = pdf[pdf["t"].isna()]
    rows = np.zeros(len(got), READING)
    rows["ts"] = got["ts"].to_numpy(np.int64)
    rows["em"] = got["em"].to_numpy(np.int64)
    for n in VALUES:
        rows[n] = got[n].to_numpy(np.float64, na_value=np.nan)
    return rows, pdf["t"].dropna().to_numpy(np.int64)


def station_step(late_us: int):
    """The state function: takes in new rows, answers the requests the watermark has passed, drops what no
    later request can need."""

    def run(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows, older, waiting = ([np.zeros(0, READING)] * 2 + [np.zeros(0, np.int64)]) if not state.exists else [
            np.frombuffer(bytes(x), d) for x, d in zip(state.get, (READING, READING, "<i8"))]
        if not state.hasTimedOut:
            for pdf in pdfs:
                more, asked = _arrived(pdf)
                rows, waiting = np.concatenate([rows, more]), np.concatenate([waiting, asked])
        rows = _sorted(rows)
        passed = state.getCurrentWatermarkMs()
        ready = waiting // 1000 + 1 < passed
        answers = []
        for t in waiting[ready].tolist():
            expired = t < passed * 1000 - late_us
            answers.append((key[0], t, expired, *([np.nan] * len(OUTPUT) if expired else parts_at(rows, older, t))))
        waiting = np.sort(waiting[~ready])
        # requests still to come are not older than the watermark less their allowance
        horizon = passed * 1000 - late_us - LONG_WINDOW_MIN * MINUTE_US
        gone = int(np.searchsorted(rows["ts"], horizon))
        if gone:
            older = _sorted(np.concatenate([older, rows[gone - 1:gone]]))[-1:]
            rows = rows[gone:]
        state.update((rows.tobytes(), older.tobytes(), waiting.astype("<i8").tobytes()))
        if len(waiting):
            state.setTimeoutTimestamp(max(int(waiting[0]) // 1000, passed) + 1)
        if answers:
            yield pd.DataFrame(answers, columns=["station_id", "t", "expired", *OUTPUT])

    return run


def live_parts(readings: DataFrame, requests: DataFrame, delay: str, late_us: int) -> DataFrame:
    """Parts of every answered request, from a stream of readings and a stream of requests. ``delay`` is how far out of order
    readings arrive; later ones are dropped. Rows without a station or a time are dropped."""
    r = readings.where("station_id IS NOT NULL AND window_start IS NOT NULL").select(
        "station_id", F.col("window_start").cast("timestamp").alias("event_time"),
        micros("window_start").alias("ts"), F.coalesce(micros("emitted_at"), F.lit(NO_EMISSION)).alias("em"),
        *(F.col(c).cast("double").alias(n) for n, c in VALUES.items()))
    # requests have no event time: they neither move the watermark nor are late for it
    q = requests.where("station_id IS NOT NULL AND obs_ts IS NOT NULL").select(
        "station_id", F.lit(None).cast("timestamp").alias("event_time"), micros("obs_ts").alias("t"))
    both = r.withWatermark("event_time", delay).withColumn("t", F.lit(None).cast("long")).unionByName(q, allowMissingColumns=True)
    answers = both.groupBy("station_id").applyInPandasWithState(
        station_step(late_us), ANSWER, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    snap = F.struct(F.col("snap_ts").cast("long").alias("ts"), *(F.col(f"snap_{n}").alias(n) for n in RECORD[1:]))
    return answers.select(
        "station_id", from_micros("t").alias("obs_ts"), "expired",
        F.when(F.col("snap_ts").isNotNull(), snap).alias("snap"),
        *(F.struct(F.col(f"lag_{o}").alias("bikes")).alias(f"asof_{o}") for o in LAG_FEATURES),
        *(F.col(f"w{w}_{s}").cast("long" if s in COUNTS else "double").alias(f"w{w}_{s}") for w, stats in WINDOWS for s in stats))


def score_live(spark: SparkSession, reading_dir: str, request_dir: str, out_dir: str, checkpoint: str, scorer,
               s: Settings | None = None, delay: str = "1 hour", late_hours: int = 24, available_now: bool = True,
               max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Score requests that arrive as files against readings that arrive as files (both Parquet). Each
    request is answered once, when the readings' watermark (newest reading less ``delay``) has passed it. One that arrives
    more than ``late_hours`` behind the watermark gets the status ``request_expired``. A request that occurs twice is answered twice.

    ``scorer`` must score a row by itself (a fitted model, or a rule with a fixed maximum)."""
    s = s or Settings()

    def source(schema, path):
        src = spark.readStream.schema(schema)
        return (src.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger else src).parquet(path)

    parts = live_parts(source(READINGS_SCHEMA, reading_dir), source(REQUEST_SCHEMA, request_dir), delay, late_hours * HOUR_US)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        feats = features_and_status(batch, s, keep=("expired",))
        late = F.col("expired")
        feats = feats.withColumns({
            "status": F.when(late, STATUS_EXPIRED).otherwise(F.col("status")),
            "http_status": F.when(late, EXPIRED_CODE).otherwise(F.col("http_status"))})
        score_features(feats, scorer, s).write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/epoch={epoch_id}")

    w = parts.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()
