"""Triage: ranking, truncation, skips, funnel, errors, plan C = plan R."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import pytest

from dockwatch.ml.scorers import RuleScorer
from dockwatch.plans.scoring import reconstruct_features
from dockwatch.plans.triage import TriageError, active_stations, candidate_features, triage, triage_result
from dockwatch.settings import FEATURE_COLUMNS, Settings

T930 = datetime(2024, 6, 15, 9, 30)


def test_ranking_and_funnel(readings):
    res = triage_result(readings, T930, RuleScorer(), Settings(), top_n=10)
    assert res["candidate_stations"] == 2 and res["scored"] == 2 and res["skipped"] == 0
    st = res["stations"]
    assert [s["station_id"] for s in st] == ["S1", "S2"]
    assert [s["rank"] for s in st] == [1, 2]
    assert st[0]["risk_score"] >= st[1]["risk_score"]
    assert res["candidate_stations"] == res["scored"] + res["skipped"]


def test_top_n_truncation_and_bounds(readings):
    res = triage_result(readings, T930, RuleScorer(), Settings(), top_n=1)
    assert res["scored"] == 2 and len(res["stations"]) == 1 and res["stations"][0]["rank"] == 1
    assert res["top_n"] == 1
    for bad in (0, 51):
        with pytest.raises(ValueError):
            triage(readings, T930, RuleScorer(), Settings(), top_n=bad)


def test_no_active_stations(readings):
    with pytest.raises(TriageError) as e:
        triage_result(readings, datetime(2030, 1, 1), RuleScorer(), Settings())
    assert e.value.code == "no_active_stations" and e.value.status == 404


def test_capacity_floor_setting_and_debug_columns(spark, readings):
    # one capacity floor serves discovery and the domain check: lowered to 2,
    # S3 (capacity 3) becomes a candidate and is scored, not skipped
    s = Settings(min_capacity=2.0)
    res = triage(readings, T930, RuleScorer(), s, debug=True)
    assert {r["station_id"] for r in res["skipped"].collect()} == set()
    s2 = Settings(min_capacity=2.0)
    cand = candidate_features(readings, T930, s2).collect()
    assert len(cand) == 3
    ranked = res["ranked"]
    assert ranked.columns[-3:] == ["availability_ratio", "snapshot_age_min", "bikes_delta_60m"]
    assert all(r["snapshot_age_min"] == 0.0 for r in ranked.collect())


def test_skipped_reason_when_newest_is_small(spark):
    from dockwatch.sources.readings import READINGS_SCHEMA
    t0 = datetime(2024, 6, 15, 9, 0)
    rows = []
    for i in range(20):
        cap = 30.0 if i < 19 else 3.0   # newest reading below the floor
        ws = t0 + timedelta(minutes=i)
        rows.append(("Q", ws, ws + timedelta(minutes=1), 5.0, cap - 5.0, cap, 5.0 / cap, 0, 1,
                     ws + timedelta(minutes=1)))
    df = spark.createDataFrame(rows, READINGS_SCHEMA)
    res = triage_result(df, t0 + timedelta(minutes=19), RuleScorer(), Settings())
    assert res["candidate_stations"] == 1 and res["scored"] == 0 and res["stations"] == []
    assert res["skip_reasons"] == {"out_of_domain": 1}


def test_deterministic(readings):
    a = triage_result(readings, T930, RuleScorer(), Settings())["stations"]
    b = triage_result(readings, T930, RuleScorer(), Settings())["stations"]
    assert a == b


def test_active_stations_sorted(readings):
    assert [r[0] for r in active_stations(readings, T930, Settings()).collect()] == ["S1", "S2"]


@pytest.mark.parametrize("t,lookback", [
    (datetime(2024, 3, 2, 6, 0), 2880), (datetime(2024, 3, 2, 13, 7, 41), 2880),
    (datetime(2024, 3, 3, 23, 59), 2880), (datetime(2024, 3, 3, 23, 59), None),
    (datetime(2024, 3, 3, 23, 59), 0), (datetime(2024, 3, 2, 13, 7, 41), 0)])
def test_plan_c_equals_plan_r(spark, random_readings, t, lookback):
    """Bounded first pass (with the older-history fallback), one full pass and a
    zero look-back (fallback for every lag at 24h) all equal plan R."""
    s = Settings()
    c = {r["station_id"]: r.asDict()
         for r in candidate_features(random_readings, t, s, lookback).collect()}
    req = spark.createDataFrame([(k, t) for k in c], "station_id string, obs_ts timestamp_ntz")
    r = {x["station_id"]: x.asDict() for x in reconstruct_features(random_readings, req, s).collect()}
    assert c.keys() == r.keys()
    for k in c:
        assert c[k]["status"] == r[k]["status"]
        for col in FEATURE_COLUMNS:
            a, b = c[k][col], r[k][col]
            assert (a is None and b is None) or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9), (k, col)


def test_scan_filter_is_pushed(readings, tmp_path, spark):
    readings.write.parquet(str(tmp_path / "r"))
    from dockwatch.sources.readings import load_readings
    r = load_readings(spark, str(tmp_path / "r"))
    plan = candidate_features(r, T930, Settings())._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(window_start), LessThanOrEqual(window_start" in plan


def test_ok_request_without_a_score_has_its_own_outcome(spark):
    from dockwatch.plans.scoring import score_requests
    from dockwatch.sources.readings import READINGS_SCHEMA

    t0 = datetime(2024, 6, 15, 9, 0)
    rows = [(sid, t0, t0 + timedelta(minutes=1), bikes, 5.0, 30.0, 0.2, 0, 1, t0) for sid, bikes in (("K", 4.0), ("U", None))]
    df = spark.createDataFrame(rows, READINGS_SCHEMA)
    res = triage_result(df, t0, RuleScorer(), Settings())
    assert (res["candidate_stations"], res["scored"], res["skipped"]) == (2, 1, 1)
    assert [x["station_id"] for x in res["stations"]] == ["K"] and res["skip_reasons"] == {"no_score": 1}
    req = spark.createDataFrame([("K", t0), ("U", t0)], "station_id string, obs_ts timestamp_ntz")
    got = {r["station_id"]: r for r in score_requests(df, req, RuleScorer()).collect()}
    assert (got["U"]["status"], got["U"]["http_status"], got["U"]["risk_label"], got["U"]["threshold"]) == ("no_score", 422, None, None)
    assert got["K"]["status"] == "ok" and got["K"]["risk_score"] == 0.0
