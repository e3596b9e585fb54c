"""Scoring: training/serving feature consistency, request statuses, plan R
against the general union plan at arbitrary instants."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dockwatch.functions.timeexpr import micros
from dockwatch.ml.scorers import RuleScorer
from dockwatch.plans.dataset import build_dataset, union_parts
from dockwatch.plans.features import with_features
from dockwatch.plans.scoring import reconstruct_features, score_requests
from dockwatch.settings import FEATURE_COLUMNS, Settings

from .conftest import BASE

S10 = Settings(min_forward_rows=10)


def _req(spark, pairs):
    return spark.createDataFrame(pairs, "station_id string, obs_ts timestamp_ntz")


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-9)


@pytest.mark.parametrize("broadcast", [True, False])
def test_online_features_match_training(spark, readings, broadcast):
    ds = build_dataset(readings, S10)
    req = ds.select("station_id", "obs_ts")
    on = reconstruct_features(readings, req, S10, broadcast_requests=broadcast)
    j = ds.alias("d").join(on.alias("o"), ["station_id", "obs_ts"])
    rows = j.select(*[F.col(f"d.{c}").alias(f"d_{c}") for c in FEATURE_COLUMNS],
                    *[F.col(f"o.{c}").alias(f"o_{c}") for c in FEATURE_COLUMNS]).collect()
    assert len(rows) == ds.count()
    bad = [(c, r[f"d_{c}"], r[f"o_{c}"]) for r in rows for c in FEATURE_COLUMNS
           if not _close(r[f"d_{c}"], r[f"o_{c}"])]
    assert not bad, bad[:5]


def test_feature_column_order_and_source_ts(spark, readings):
    out = reconstruct_features(readings, _req(spark, [("S1", BASE + timedelta(minutes=60))]), S10)
    cols = out.columns
    assert cols[3:3 + len(FEATURE_COLUMNS)] == FEATURE_COLUMNS
    r = out.first()
    assert r["snapshot_source_ts"] == BASE + timedelta(minutes=60)
    assert r["status"] == "ok" and r["http_status"] == 200


def test_request_statuses(spark, readings):
    req = _req(spark, [
        ("NONEXISTENT", datetime(2024, 6, 15, 9, 0)),
        ("S3", datetime(2024, 6, 15, 9, 0)),
        ("S1", datetime(2024, 6, 15, 12, 0)),
        ("S1", datetime(2024, 6, 14, 0, 0)),
        ("S1", datetime(2024, 6, 15, 11, 14)),   # newest reading 10:59: exactly 15 min, passes
        ("S1", datetime(2024, 6, 15, 11, 14, 1)),
    ])
    st = {(r["station_id"], r["obs_ts"]): (r["status"], r["http_status"])
          for r in reconstruct_features(readings, req, S10).collect()}
    assert st[("NONEXISTENT", datetime(2024, 6, 15, 9, 0))] == ("station_not_found", 404)
    assert st[("S3", datetime(2024, 6, 15, 9, 0))] == ("out_of_domain", 422)
    assert st[("S1", datetime(2024, 6, 15, 12, 0))] == ("stale_data", 422)
    assert st[("S1", datetime(2024, 6, 14, 0, 0))] == ("station_not_found", 404)
    assert st[("S1", datetime(2024, 6, 15, 11, 14))][0] == "ok"
    assert st[("S1", datetime(2024, 6, 15, 11, 14, 1))][0] == "stale_data"


def test_score_requests_rule(spark, readings):
    req = _req(spark, [("S1", BASE + timedelta(minutes=100)), ("S2", BASE + timedelta(minutes=100)),
                       ("X", BASE)])
    out = {r["station_id"]: r for r in score_requests(readings, req, RuleScorer(), S10).collect()}
    assert out["S1"]["risk_score"] == 1.0 and out["S1"]["risk_label"] == 1
    assert out["S2"]["risk_score"] == 0.0 and out["S2"]["risk_label"] == 0
    assert out["X"]["status"] == "station_not_found" and out["X"]["risk_score"] is None


def test_plan_r_equals_union_plan_off_grid(spark, random_readings):
    """Arbitrary instants (seconds off the grid, exactly on readings, on the
    grid) through plan R and through the general union plan."""
    s = Settings()
    base = datetime(2024, 3, 1, 0, 0)
    pts = []
    for sid in ("R0", "R1", "R2", "R3", "RX"):
        for k in range(0, 3 * 24 * 60, 97):
            pts.append((sid, base + timedelta(minutes=k, seconds=(k * 13) % 60)))
        pts.append((sid, base + timedelta(hours=30)))
    req = _req(spark, pts)
    r = reconstruct_features(random_readings, req, s)
    left = req.distinct().withColumn("obs_us", micros("obs_ts"))
    u = union_parts(random_readings, left.select("station_id", "obs_us"), s, with_label=False)
    u = with_features(u.join(left, ["station_id", "obs_us"]), FEATURE_COLUMNS)
    a = {(x["station_id"], x["obs_ts"]): x.asDict() for x in r.collect()}
    b = {(x["station_id"], x["obs_ts"]): x.asDict() for x in u.collect()}
    assert len(a) == len(pts) - 0 or len(a) == len(set(pts))
    bad = [(k, c, a[k][c], b.get(k, {}).get(c)) for k in a for c in FEATURE_COLUMNS
           if k in b and not _close(a[k][c], b[k][c])]
    missing = [k for k in a if k not in b and a[k]["status"] != "station_not_found"]
    assert not bad, bad[:5]
    assert not missing
