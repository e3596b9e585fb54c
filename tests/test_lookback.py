"""Newest rows by hash aggregation, the station look-back index, and plans that scan bounded ranges."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dockwatch.functions.timeexpr import MINUTE_US, ts_literal_micros
from dockwatch.ml.scorers import RuleScorer
from dockwatch.operators.newest import key_time, newest_aggs, newest_key, newest_record
from dockwatch.plans.dataset import build_dataset, union_parts
from dockwatch.plans.features import with_features
from dockwatch.plans.lookback import newest_before, station_days
from dockwatch.plans.scoring import reconstruct_features, score_requests
from dockwatch.plans.triage import candidate_features, triage
from dockwatch.settings import FEATURE_COLUMNS, Settings
from dockwatch.sources.readings import READINGS_SCHEMA, load_readings

SPAN = 15 * MINUTE_US
REQ = "station_id string, obs_ts timestamp_ntz"


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def test_packed_key_orders_by_time_then_emission(spark):
    rnd = random.Random(4)
    delays = [None, -5_000_000, 0, 1, 60_000_000, 60_000_001, 3_000_000_000, 4_000_000_000, 90_000_000_000, 10**13]
    rows = [(t, d) for t in [0, 1, 59_999_999, SPAN - 1] for d in delays]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(t, None if d is None else t + d) for t, d in rows], "t long, e long")
    df = df.withColumn("k", newest_key(F.col("t"), F.col("e"), F.lit(0), SPAN)).withColumn("back", key_time(F.col("k"), F.lit(0), SPAN))
    got = df.collect()
    assert all(r.t == r.back for r in got)
    want = sorted(got, key=lambda r: (r.t, -(10**18) if r.e is None else r.e))
    assert sorted(got, key=lambda r: r.k) == want
    assert len({r.k for r in got}) == len(got)


def test_newest_record_keeps_null_values_and_uses_no_sort(spark):
    rows = [("a", 5, 1, 1.0), ("a", 7, 2, None), ("a", 7, 1, 3.0), ("b", 1, None, 4.0), ("b", 1, 1, 5.0), ("c", 2, 1, 6.0)]
    df = spark.createDataFrame(rows, "g string, t long, e long, v double")
    k = newest_key(F.col("t"), F.col("e"), F.lit(0), SPAN)
    agg = df.groupBy("g").agg(*newest_aggs(k, {"v": F.col("v")}, "r"), *newest_aggs(k, {"v": F.col("v")}, "s", F.col("g") != "c"))
    out = agg.select("g", newest_record("r", ("v",), F.lit(0), SPAN).alias("r"), newest_record("s", ("v",), F.lit(0), SPAN).alias("s"))
    got = {r.g: r for r in out.collect()}
    assert tuple(got["a"].r) == (7, None)
    assert tuple(got["b"].r) == (1, 5.0)
    assert got["c"].s is None and tuple(got["c"].r) == (2, 6.0)
    assert "SortAggregate" not in _plan(out)


def test_raw_readings_are_never_sorted_to_aggregate(spark, random_readings):
    s = Settings(min_forward_rows=10)
    assert "SortAggregate" not in _plan(build_dataset(random_readings, s))
    t = datetime(2024, 3, 3, 6, 0)
    req = spark.createDataFrame([("R0", t)], REQ)
    plan = _plan(reconstruct_features(random_readings, req, s)) + _plan(triage(random_readings, t, RuleScorer(), s)["ranked"])
    # an aggregate of structs sorts only the records that a hash aggregate made before
    sorts = [x for x in plan.split("\n") if "SortAggregate" in x]
    assert not any("avg_bikes_available" in x or "avg_capacity" in x for x in sorts)


@pytest.fixture(scope="module")
def sparse(spark):
    """Stations with weeks of silence, and one that starts late."""
    rnd = random.Random(8)
    rows = []
    for sid, days in (("A", [0, 1, 40, 41]), ("B", [3]), ("C", [39, 40, 41]), ("D", [0, 20, 39])):
        for d in days:
            for m in sorted(rnd.sample(range(1440), 60)):
                ws = datetime(2024, 1, 1) + timedelta(days=d, minutes=m)
                bikes = None if rnd.random() < 0.1 else float(rnd.randint(0, 20))
                rows.append((sid, ws, ws + timedelta(minutes=1), bikes, 3.0, 20.0, 0.5, 1, 2, ws + timedelta(minutes=1)))
    return spark.createDataFrame(rows, READINGS_SCHEMA)


def sparse_requests(spark):
    start = datetime(2024, 1, 1)
    pts = [(sid, start + timedelta(days=d, minutes=m)) for sid in "ABCDX" for d in (0, 1, 2, 5, 39, 40, 41, 43) for m in (0, 487, 1439)]
    return spark.createDataFrame(pts, REQ)


def _rows(df):
    return sorted(map(tuple, df.select("station_id", "obs_ts", *FEATURE_COLUMNS).collect()), key=str)


@pytest.mark.parametrize("given", [False, True])
def test_lookback_over_weeks_equals_the_general_plan(spark, sparse, given):
    q = sparse_requests(spark)
    index = station_days(sparse) if given else None
    got = reconstruct_features(sparse, q, Settings(), index=index).where("status <> 'station_not_found'")
    left = q.withColumn("obs_us", F.unix_micros(F.col("obs_ts").cast("timestamp")))
    u = union_parts(sparse, left.select("station_id", "obs_us"), Settings(), with_label=False).where("snap IS NOT NULL")
    want = with_features(u.join(left, ["station_id", "obs_us"]), FEATURE_COLUMNS)
    assert _rows(got) == _rows(want)
    assert len(_rows(want)) > 50


def test_index_holds_a_row_per_station_and_day(spark, sparse):
    idx = station_days(sparse)
    rows = {(r.station_id, r.day): r for r in idx.collect()}
    assert len(rows) == 11 and all(r.readings == 60 for r in rows.values())
    for r in rows.values():
        assert ts_literal_micros(r.last_seen) == r.rec["ts"] and r.first_seen < r.last_seen
    day = ts_literal_micros(datetime(2024, 1, 21))
    pts = spark.createDataFrame([("A", day), ("D", day), ("C", day), ("X", day)], "station_id string, day long")
    got = {r.station_id: r.old for r in newest_before(pts, idx).collect()}
    assert got["C"] is None and got["X"] is None
    assert got["A"]["ts"] == rows[("A", ts_literal_micros(datetime(2024, 1, 2)))].rec["ts"]
    assert got["D"]["ts"] == rows[("D", ts_literal_micros(datetime(2024, 1, 1)))].rec["ts"]


def test_requests_are_kept_one_by_one(spark, readings):
    t = datetime(2024, 6, 15, 9, 0)
    req = spark.createDataFrame([("S1", t), ("S1", t), ("S2", t), (None, t), ("S1", None), (None, None)], REQ)
    rows = [(r.station_id, r.obs_ts, r.status) for r in reconstruct_features(readings, req).collect()]
    assert sorted(rows, key=str) == sorted([("S1", t, "ok"), ("S1", t, "ok"), ("S2", t, "ok"), (None, t, "station_not_found"),
                                            ("S1", None, "station_not_found"), (None, None, "station_not_found")], key=str)
    assert score_requests(readings, req.limit(0), RuleScorer()).count() == 0


def test_scans_are_bounded_and_few(spark, sparse, tmp_path):
    sparse.write.parquet(f"{tmp_path}/r")
    r = load_readings(spark, f"{tmp_path}/r")
    t = datetime(2024, 2, 10, 12, 30)
    req = spark.createDataFrame([(s, t) for s in "ABC"], REQ)
    bound = r"GreaterThanOrEqual\(window_start,2024-02-09T00:00\)"
    plan = _plan(reconstruct_features(r, req))
    assert len(re.findall(r"FileScan parquet [^\n]*window_start", plan)) <= 2
    assert re.search(bound, plan)
    # with an index, no scan of readings lacks the lower bound
    station_days(r).write.parquet(f"{tmp_path}/index")
    index = spark.read.parquet(f"{tmp_path}/index")
    for df in (reconstruct_features(r, req, index=index), candidate_features(r, t, Settings(), index=index)):
        scans = [x for x in _plan(df).split("\n") if "FileScan" in x and f"{tmp_path}/r]" in x]
        assert scans and all("GreaterThanOrEqual(win" in x for x in scans)  # Spark cuts long lists
    assert _rows(reconstruct_features(r, req, index=index)) == _rows(reconstruct_features(r, req))
