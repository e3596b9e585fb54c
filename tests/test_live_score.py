"""Stateful streaming scoring: equal to batch scoring, whatever the micro-batches, restarts and silence."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from dockwatch.catalog_stream import arriving
from dockwatch.functions.timeexpr import MINUTE_US, ntz_literal, ts_literal_micros
from dockwatch.ml.scorers import RuleScorer
from dockwatch.plans.scoring import score_requests
from dockwatch.settings import Settings
from dockwatch.streaming import live_score
from dockwatch.streaming.live_score import READING, score_live, station_step

START = datetime(2024, 3, 1)
RULE = RuleScorer(max_bikes=30.0)
COLUMNS = ["station_id", "obs_ts", "risk_score", "risk_label", "snapshot_source_ts", "status", "http_status"]


def _requests(spark, hours=range(0, 80, 5)):
    pts = [(s, START + timedelta(hours=h, minutes=7 * k, seconds=13 * k)) for s in ("R0", "R1", "R2", "RX") for k, h in enumerate(hours)]
    return spark.createDataFrame([*pts, pts[3], ("R0", None), (None, START)], "station_id string, obs_ts timestamp_ntz")


def _rows(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=str)


@pytest.fixture(scope="module")
def files(spark, random_readings, tmp_path_factory):
    base = tmp_path_factory.mktemp("live")
    few = random_readings.where("station_id <> 'R3'").coalesce(1)
    arriving(few, f"{base}/readings", 12)
    _requests(spark).repartition(2).write.parquet(f"{base}/requests")
    newest = few.agg(F.max("window_start")).first()[0]
    return base, few, newest


@pytest.fixture(scope="module")
def expected(spark, files):
    _, few, newest = files
    asked = _requests(spark).where(F.col("station_id").isNotNull() & (F.col("obs_ts") < ntz_literal(newest - timedelta(hours=12))))
    return _rows(score_requests(few, asked, RULE))


@pytest.mark.parametrize("batch_files", [1, 3])
def test_micro_batches_do_not_change_the_answers(spark, files, expected, tmp_path, batch_files):
    base, few, _ = files
    q = score_live(spark, f"{base}/readings", f"{base}/requests", f"{tmp_path}/out", f"{tmp_path}/ck", RULE, delay="12 hours",
                   late_hours=200, max_files_per_trigger=batch_files)
    q.awaitTermination()
    assert len(expected) > 30
    assert _rows(spark.read.parquet(f"{tmp_path}/out")) == expected
    # every row is read once: no batch reads history
    assert sum(p.numInputRows for p in q.recentProgress) == few.count() + _requests(spark).count()


def test_restart_after_a_failure_and_with_more_files(spark, files, expected, tmp_path):
    base, few, _ = files
    half = START + timedelta(hours=36)
    arriving(few.where(F.col("window_start") < ntz_literal(half)), f"{tmp_path}/readings", 12)
    spark.read.parquet(f"{base}/requests").write.parquet(f"{tmp_path}/requests")

    class Failing(RuleScorer):
        calls = 0

        def score(self, features):
            Failing.calls += 1
            if Failing.calls == 3:
                raise RuntimeError("lost")
            return super().score(features)

    def run(scorer):
        q = score_live(spark, f"{tmp_path}/readings", f"{tmp_path}/requests", f"{tmp_path}/out", f"{tmp_path}/ck", scorer,
                       delay="12 hours", late_hours=200, max_files_per_trigger=1)
        q.awaitTermination()

    with pytest.raises(Exception, match="lost"):
        run(Failing(max_bikes=30.0))
    run(RULE)
    arriving(few.where(F.col("window_start") >= ntz_literal(half)), f"{tmp_path}/readings", 12)
    run(RULE)
    assert _rows(spark.read.parquet(f"{tmp_path}/out")) == expected


class State:
    """Stands in for a group's state."""

    def __init__(self):
        self.get, self.exists, self.hasTimedOut, self.watermark, self.timeout = None, False, False, 0, None

    def getCurrentWatermarkMs(self):
        return self.watermark

    def update(self, value):
        self.get, self.exists = value, True

    def setTimeoutTimestamp(self, ms):
        assert ms > self.watermark
        self.timeout = ms


def _frame(minutes=(), requests=()):
    us = ts_literal_micros(START)
    rows = [{"t": None, "ts": us + m * MINUTE_US, "em": live_score.NO_EMISSION, "bikes": float(m % 7), "docks": 1.0, "cap": 20.0,
             "ratio": None, "low": 0.0, "ev": 1.0} for m in minutes]
    rows += [{"t": us + m * MINUTE_US} for m in requests]
    return pd.DataFrame(rows, columns=["t", "ts", "em", *live_score.VALUES])


def test_state_is_bounded_and_keeps_the_newest_older_reading():
    step, state, ms = station_step(60 * MINUTE_US), State(), ts_literal_micros(START) // 1000
    for day in range(6):
        list(step(("A",), iter([_frame(range(1440 * day, 1440 * (day + 1), 3))]), state))
        state.watermark = ms + 1440 * (day + 1) * 60_000
    list(step(("A",), iter([_frame()]), state))
    rows, older = (np.frombuffer(x, READING) for x in state.get[:2])
    assert 25 * 20 - 1 <= len(rows) <= 25 * 20 + 1
    assert len(older) == 1 and older["ts"][0] < rows["ts"][0]
    # a month of silence: only the newest reading is left, and it still answers
    state.watermark = ms + 40 * 1440 * 60_000
    (out,) = step(("A",), iter([_frame((), [40 * 1440 - 5])]), state)
    assert len(state.get[0]) == 0 and len(state.get[1]) == READING.itemsize
    assert out["snap_ts"][0] == ts_literal_micros(START) + (6 * 1440 - 3) * MINUTE_US
    assert out["w60_bcnt"][0] == 0 and np.isnan(out["w60_bsum"][0]) and np.isnan(out["w1440_ev"][0])


def test_late_requests_expire_and_waiting_ones_set_a_timer():
    step, state, ms = station_step(60 * MINUTE_US), State(), ts_literal_micros(START) // 1000
    state.watermark = ms + 600 * 60_000
    (out,) = step(("A",), iter([_frame(range(0, 600), [500, 590, 700, 800])]), state)
    assert out["expired"].tolist() == [True, False]
    assert state.timeout == ms + 700 * 60_000 + 1
    assert np.isnan(out["snap_ts"][0]) and out["snap_bikes"][1] == 590 % 7


def test_fitted_rule_scores_rows_by_themselves(spark):
    rows = spark.createDataFrame([(2.0,), (None,), (8.0,)], "ft_bikes_available double")
    rule = RuleScorer.fitted(rows, "ft_bikes_available")
    assert rule.max_bikes == 8.0
    assert [r.raw_score for r in rule.score(rows.limit(1)).collect()] == [0.75]
    assert RuleScorer.fitted(rows.limit(0), "ft_bikes_available").max_bikes == 0.0
