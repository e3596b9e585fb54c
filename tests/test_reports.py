"""Reports: attrition, coverage, sensitivity, validation, inspection, and the
generic operators (as-of join, range join, percentiles) against brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockwatch.operators.asof import asof_join
from dockwatch.operators.percentiles import percentiles_from_hist
from dockwatch.operators.ranges import range_join
from dockwatch.plans.dataset import build_dataset
from dockwatch.reports import diagnose as G
from dockwatch.reports import validation as V
from dockwatch.settings import DATASET_COLUMNS, Settings

from .conftest import BASE

S10 = Settings(min_forward_rows=10)


def test_station_attrition(readings):
    r = G.station_attrition(readings, S10).first()
    assert (r["source_stations"], r["after_capacity"], r["after_forward"]) == (3, 2, 2)
    assert r["dropped_capacity"] == 1 and r["capacity_drop_pct"] == pytest.approx(100 / 3)


def test_observation_attrition_and_distribution(readings):
    o = G.obs_attrition(readings, S10).first()
    # 12 buckets for each of S1, S2; the last one (minute 165) still sees 14 rows
    assert o["total_grid"] == 24 and o["zero_forward"] == 0 and o["with_forward"] == 24
    assert o["passing"] == 24 and o["passing_pct_of_grid"] == 100.0
    d = G.forward_count_dist(readings, S10).first()
    assert d["total_obs"] == 24 and d["max_fwd"] == 60 and d["min_fwd"] == 14
    assert d["p25_fwd"] == pytest.approx(float(np.percentile([14, 29, 44, 59] * 2 + [60] * 16, 25)))
    assert G.zero_forward_obs(readings, S10).count() == 0


def test_sensitivity_rows_for_every_threshold(spark, readings):
    rows = {r["threshold"]: r for r in G.forward_sensitivity(
        spark, readings, S10, [10, 30, 60, 61]).collect()}
    assert sorted(rows) == [10, 30, 60, 61]
    assert rows[61]["obs"] == 0 and rows[61]["stations"] == 0 and rows[61]["p50_fwd"] is None
    assert rows[60]["min_fwd"] == 60 and rows[10]["obs"] >= rows[30]["obs"] >= rows[60]["obs"]


def test_validation_passes_on_built_dataset(readings):
    ok, rep = V.validate_dataset(build_dataset(readings, S10))
    assert ok and rep["schema_ok"] and rep["summary"]["duplicate_keys"] == 0
    sev = {r["column_name"]: r["severity"] for r in rep["null_rates"]}
    assert sev["ft_bikes_available_lag_24h"] == "WARN" and sev["station_id"] == "ok"


def test_validation_catches_duplicates_and_bad_target(readings):
    ds = build_dataset(readings, S10)
    bad = ds.unionByName(ds.limit(1)).withColumn(
        "target_empty_next_hour",
        F.when(F.col("obs_ts") == F.lit(BASE + timedelta(minutes=15)), 2)
        .otherwise(F.col("target_empty_next_hour")))
    ok, rep = V.validate_dataset(bad)
    assert not ok and rep["summary"]["duplicate_keys"] == 1
    assert rep["summary"]["non_binary_targets"] >= 1
    ok2, rep2 = V.validate_dataset(ds.select(*reversed(DATASET_COLUMNS)))
    assert not ok2 and not rep2["schema_ok"]


def test_inspection(readings):
    ds = build_dataset(readings, S10)
    one = G.inspect_dataset(ds, "S1", BASE + timedelta(minutes=60), BASE + timedelta(minutes=60))
    assert one.count() == 1
    around = G.inspect_raw_around(readings, one, 5).collect()
    assert len(around) == 11 and sum(r["is_obs"] for r in around) == 1
    fwd = G.inspect_forward_rows(readings, one, S10)
    rows = fwd.collect()
    assert len(rows) == 60 and sum(r["is_low"] for r in rows) == 31  # minutes 90..120
    trim = G.inspect_forward_trim(fwd).collect()
    assert sorted(r["row_pos"] for r in trim) == [1, 2, 3, 58, 59, 60]
    j = G.label_justification(fwd, S10).first()
    assert j["implied_label"] == 1 and j["min_bikes_fwd"] == 0.0
    assert G.station_reading_count(readings, "S9") == 0


def test_asof_join_matches_brute_force(spark):
    rnd = random.Random(1)
    t0 = datetime(2024, 1, 1)
    right = [(k, t0 + timedelta(seconds=rnd.randint(0, 5000)), float(i))
             for i, k in enumerate(rnd.choice("ab") for _ in range(300))]
    left = [(k, t0 + timedelta(seconds=rnd.randint(-100, 5100))) for k in (rnd.choice("abc")
                                                                             for _ in range(200))]
    L = spark.createDataFrame(left, "k string, t timestamp_ntz").distinct()
    R_ = spark.createDataFrame(right, "k string, rt timestamp_ntz, v double")
    got = {(r["k"], r["t"]): (r["rt"], r["rt_60000000"]) for r in asof_join(
        L, R_, "k", "t", "rt", ["v"], offsets_us=(0, 60_000_000), how="left").collect()}
    for k, t in set(left):
        cands = [x for x in right if x[0] == k and x[1] <= t]
        exp = max(cands, key=lambda x: (x[1], x[2]))[1] if cands else None
        c60 = [x for x in right if x[0] == k and x[1] <= t - timedelta(minutes=1)]
        exp60 = max(c60, key=lambda x: (x[1], x[2]))[1] if c60 else None
        assert got[(k, t)] == (exp, exp60)
    inner = asof_join(L, R_, "k", "t", "rt", ["v"], how="inner").count()
    assert inner == sum(1 for k, t in set(left) if any(x[0] == k and x[1] <= t for x in right))


def test_range_join_matches_brute_force(spark):
    rnd = random.Random(2)
    left = [(rnd.choice("ab"), i, rnd.randint(0, 1000)) for i in range(100)]
    left = [(k, i, lo, lo + rnd.randint(0, 200)) for k, i, lo in left]
    right = [(rnd.choice("ab"), rnd.randint(0, 1300)) for _ in range(400)]
    L = spark.createDataFrame(left, "k string, id int, lo long, hi long")
    R_ = spark.createDataFrame(right, "k string, t long").withColumn("rid", F.monotonically_increasing_id())
    got = range_join(L, R_, "k", "lo", "hi", "t", bin_us=64, lo_inclusive=False).count()
    exp = sum(1 for k, _, lo, hi in left for k2, t in right if k == k2 and lo < t <= hi)
    assert got == exp


def test_percentiles_match_numpy(spark):
    rnd = random.Random(5)
    vals = [rnd.randint(1, 40) for _ in range(999)]
    df = spark.createDataFrame([(v,) for v in vals], "v long").groupBy("v").agg(
        F.count(F.lit(1)).alias("c"))
    got = percentiles_from_hist(df, "v", "c", [0.25, 0.5, 0.75, 0.9]).first()
    for p, name in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"), (0.9, "p90")):
        assert got[name] == pytest.approx(float(np.percentile(vals, p * 100)))


def test_station_predicate_pushed_through_window(spark, readings, tmp_path):
    from dockwatch.sources.readings import load_readings
    readings.write.parquet(str(tmp_path / "r"))
    r = load_readings(spark, str(tmp_path / "r"))
    d = G.inspect_dataset(build_dataset(r, S10), "S1", BASE, BASE + timedelta(hours=1))
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(station_id,S1)" in plan
    assert d.count() == 5
