"""Dataset build: schema, labels, features (known answers) and plan equality."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dockwatch.plans.dataset import build_dataset, forward_label
from dockwatch.settings import DATASET_COLUMNS, Settings

from .conftest import BASE

S10 = Settings(min_forward_rows=10)


def at(minutes):
    return BASE + timedelta(minutes=minutes)


@pytest.fixture(scope="module")
def ds(readings):
    return {(r["station_id"], r["obs_ts"]): r.asDict()
            for r in build_dataset(readings, S10).collect()}


def test_columns_in_order(readings):
    assert build_dataset(readings, S10).columns == DATASET_COLUMNS


def test_small_station_excluded_and_binary_target(ds):
    assert {k[0] for k in ds} == {"S1", "S2"}
    assert {r["target_empty_next_hour"] for r in ds.values()} <= {0, 1}


def test_s1_has_positives_s2_none(ds):
    assert any(r["target_empty_next_hour"] == 1 for k, r in ds.items() if k[0] == "S1")
    assert all(r["target_empty_next_hour"] == 0 for k, r in ds.items() if k[0] == "S2")


def test_label_known_answers(readings):
    lab = {(r["station_id"], r["obs_ts"]): r for r in forward_label(readings, S10).collect()}
    assert lab[("S1", at(15))]["target_empty_next_hour"] == 0
    assert lab[("S1", at(30))]["target_empty_next_hour"] == 1  # minute 90 is the window's edge
    assert lab[("S1", at(60))]["target_empty_next_hour"] == 1
    assert lab[("S1", at(60))]["fwd_row_count"] == 60
    assert lab[("S1", at(90))]["target_empty_next_hour"] == 1
    assert lab[("S2", at(30))]["target_empty_next_hour"] == 0
    assert lab[("S2", at(30))]["fwd_row_count"] == 60
    assert lab[("S1", at(60))]["label_window_end"] == at(120)


def test_feature_known_answers(ds):
    r60 = ds[("S1", at(60))]
    assert r60["ft_bikes_available"] == 10.0  # snapshot at t uses the reading starting at t
    r75 = ds[("S1", at(75))]
    assert r75["ft_avg_bikes_60m"] == 10.0 and r75["ft_min_bikes_60m"] == 10.0
    r120 = ds[("S1", at(120))]
    assert r120["ft_bikes_available_lag_30m"] == 0.0
    assert r120["ft_bikes_available_lag_24h"] is None
    # [t - 60m, t] is closed: 61 rows at 105 = minutes 45..105, 45 of them 10, 16 of them 0
    r105 = ds[("S1", at(105))]
    assert math.isclose(r105["ft_avg_bikes_60m"], 10.0 * 45 / 61, rel_tol=1e-12)
    assert r60["ft_hour_of_day"] == 9 and r60["ft_day_of_week"] == 6 and r60["ft_is_weekend"] == 1
    assert r60["ft_pct_bikes_of_capacity"] == pytest.approx(10 / 30)
    assert r60["feature_cutoff_ts"] == r60["obs_ts"]


def test_no_leakage_snapshot_never_after_obs(readings):
    d = build_dataset(readings, S10)
    # no snapshot may come from after obs_ts: S1's drop at minute 90 appears only from 90 on
    rows = d.filter((F.col("station_id") == "S1") & (F.col("obs_ts") < F.lit(at(90)))).collect()
    assert rows and all(r["ft_bikes_available"] == 10.0 for r in rows)
    assert all(r["ft_min_bikes_60m"] == 10.0 for r in rows)


def _rows_by_key(df):
    return {(r["station_id"], r["obs_ts"]): r.asDict() for r in df.collect()}


def _same(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float):
        return math.isclose(a, b, rel_tol=tol, abs_tol=tol)
    return a == b


@pytest.mark.parametrize("mfr", [10, 30])
def test_bucket_plan_equals_union_plan_on_random_readings(random_readings, mfr):
    s = Settings(min_forward_rows=mfr)
    a = _rows_by_key(build_dataset(random_readings, s, plan="union"))
    b = _rows_by_key(build_dataset(random_readings, s, plan="bucket"))
    assert a.keys() == b.keys() and len(a) > 100
    bad = [(k, c) for k in a for c in DATASET_COLUMNS if not _same(a[k][c], b[k][c])]
    assert not bad, bad[:5]


def test_non_divisor_interval_falls_back_to_union(random_readings):
    s = Settings(sample_interval_min=7, min_forward_rows=10)
    d = build_dataset(random_readings, s)
    ts = [r["obs_ts"] for r in d.select("obs_ts").limit(50).collect()]
    origin = datetime(2000, 1, 3)
    assert all(((t - origin).total_seconds() / 60) % 7 == 0 for t in ts)


@pytest.mark.parametrize("interval,horizon", [(7, 60), (10, 60), (30, 60), (60, 60), (15, 45), (20, 50)])
def test_bucket_lattice_equals_union_plan_for_any_interval(random_readings, interval, horizon):
    s = Settings(sample_interval_min=interval, label_horizon_min=horizon, min_forward_rows=20)
    few = random_readings.where("station_id IN ('R0', 'R1')")
    a = _rows_by_key(build_dataset(few, s, plan="union"))
    b = _rows_by_key(build_dataset(few, s))
    assert a.keys() == b.keys() and len(a) > 50
    bad = [(k, c) for k in a for c in DATASET_COLUMNS if not _same(a[k][c], b[k][c])]
    assert not bad, bad[:5]


def test_grid_point_in_a_bucket_without_readings(spark):
    from dockwatch.plans.dataset import dataset_parts, lattice_min
    from dockwatch.sources.readings import READINGS_SCHEMA

    s = Settings(sample_interval_min=30, min_forward_rows=1)
    assert lattice_min(s) == 15
    t = datetime(2024, 6, 15, 9, 0)
    rows = [("Q", ws, ws, 5.0, 5.0, 10.0, 0.5, 0, 1, ws) for ws in (t - timedelta(minutes=25), t + timedelta(minutes=20))]
    got = {r["obs_ts"]: r for r in dataset_parts(spark.createDataFrame(rows, READINGS_SCHEMA), s).collect()}
    # 09:00 is a point because of the reading at 09:20, though [09:00, 09:15) has none
    assert set(got) == {t - timedelta(minutes=30), t}
    assert got[t]["snap"]["bikes"] == 5.0 and got[t]["fwd_n"] == 1
    assert got[t - timedelta(minutes=30)]["snap"] is None


def test_default_plan_reads_no_raw_window(random_readings):
    s = Settings(sample_interval_min=7, min_forward_rows=10)
    plan = build_dataset(random_readings, s)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Window [") == 1
