"""Metrics, split and baselines on the small known vectors, plus AUCs against
brute force on tied random scores."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest

from dockwatch.ml import baseline as B
from dockwatch.ml import metrics as M
from dockwatch.ml import split as SP
from dockwatch.settings import DATASET_COLUMNS, FEATURE_COLUMNS


def _pred(spark, yt, yp, ys, model="m"):
    rows = [(model, int(a), int(b), float(c)) for a, b, c in zip(yt, yp, ys)]
    return spark.createDataFrame(rows, "model string, y_true int, y_pred int, y_score double")


def _metrics(spark, yt, yp, ys):
    return M.classification_metrics(_pred(spark, yt, yp, ys)).first().asDict()


def test_perfect(spark):
    m = _metrics(spark, [0, 0, 1, 1], [0, 0, 1, 1], [.1, .2, .8, .9])
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (1.0, 1.0, 1.0, 1.0)
    assert m["roc_auc"] == 1.0 and m["pr_auc"] == 1.0
    assert (m["tp"], m["tn"]) == (2, 2)


def test_inverted(spark):
    m = _metrics(spark, [0, 0, 1, 1], [1, 1, 0, 0], [.9, .8, .2, .1])
    assert (m["accuracy"], m["precision"], m["recall"]) == (0.0, 0.0, 0.0)
    assert (m["fp"], m["fn"]) == (2, 2) and m["roc_auc"] == 0.0


def test_all_negative_scores(spark):
    m = _metrics(spark, [0, 0, 1, 1], [0, 0, 0, 0], [0, 0, 0, 0])
    assert m["accuracy"] == 0.5 and m["recall"] == 0.0
    assert m["roc_auc"] is None and m["pr_auc"] is None and m["log_loss"] is not None


def test_confusion(spark):
    m = _metrics(spark, [1, 1, 0, 0, 1, 0], [1, 0, 0, 1, 1, 0], [.9, .3, .1, .7, .8, .2])
    assert (m["tp"], m["fn"], m["fp"], m["tn"]) == (2, 1, 1, 2)


def test_pr_auc_in_range(spark):
    m = _metrics(spark, [0, 0, 0, 1, 1], [0, 0, 1, 1, 1], [.1, .2, .6, .8, .9])
    assert 0.0 <= m["pr_auc"] <= 1.0


def test_one_class_gives_null(spark):
    m = _metrics(spark, [1, 1, 1], [1, 1, 0], [.2, .5, .9])
    assert m["roc_auc"] is None and m["pr_auc"] is None and m["log_loss"] is None


def _brute(yt, ys):
    pos = [s for t, s in zip(yt, ys) if t == 1]
    neg = [s for t, s in zip(yt, ys) if t == 0]
    roc = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg) / (len(pos) * len(neg))
    # PR curve: distinct thresholds high to low, starting at (recall 0, precision 1)
    pts = [(0.0, 1.0)]
    for th in sorted(set(ys), reverse=True):
        tp = sum(1 for t, s in zip(yt, ys) if s >= th and t == 1)
        fp = sum(1 for t, s in zip(yt, ys) if s >= th and t == 0)
        pts.append((tp / len(pos), tp / (tp + fp)))
    pr = sum((x1 - x0) * (y0 + y1) / 2 for (x0, y0), (x1, y1) in zip(pts, pts[1:]))
    return roc, pr


@pytest.mark.parametrize("n_ranges", [1, 7, 64])
def test_auc_matches_brute_force_with_ties(spark, n_ranges):
    rnd = random.Random(3)
    yt = [rnd.randint(0, 1) for _ in range(1500)]
    ys = [round(rnd.random(), 2) for _ in range(1500)]  # ~100 distinct scores, many ties
    df = _pred(spark, yt, [0] * len(yt), ys)
    got = M.auc_metrics(df, n_ranges=n_ranges).first()
    roc, pr = _brute(yt, ys)
    assert got["roc_auc"] == pytest.approx(roc, abs=1e-12)
    assert got["pr_auc"] == pytest.approx(pr, abs=1e-11)


def _dataset_rows(spark):
    rnd = random.Random(42)
    rows = []
    base = datetime(2024, 6, 15, 8, 0)
    for i in range(20):
        for sid in ("S0", "S1"):
            t = base + timedelta(minutes=15 * i)
            feats = [rnd.random() * 10 for _ in range(len(DATASET_COLUMNS) - 5)]
            rows.append((sid, t, t, t + timedelta(minutes=60), rnd.randint(0, 1), *feats))
    schema = ("station_id string, obs_ts timestamp_ntz, feature_cutoff_ts timestamp_ntz, "
              "label_window_end timestamp_ntz, target_empty_next_hour int, "
              + ", ".join(f"{c} double" for c in DATASET_COLUMNS[5:]))
    return spark.createDataFrame(rows, schema)


def test_split_is_temporal_and_disjoint(spark):
    df = _dataset_rows(spark)
    s = SP.temporal_split(df)
    per = {r["split"]: (r["start"], r["end"], r["rows"]) for r in SP.split_info(s).collect()}
    assert per["train"][1] < per["val"][0] <= per["val"][1] < per["test"][0]
    assert sum(v[2] for v in per.values()) == 40
    assert SP.split_overlap(s).count() == 0
    b = SP.split_bounds(df).first()
    assert b["split_ts_val"] == datetime(2024, 6, 15, 11, 19, 30)  # 08:00 + 0.7 * 4h45m
    # both stations of one timestamp land in the same split
    assert s.groupBy("obs_ts").agg({"split": "count"}).count() == 20


def test_null_rates_and_class_balance(spark):
    df = _dataset_rows(spark)
    nr = {r["feature"]: r["null_rate"] for r in SP.feature_null_rates(df).collect()}
    assert list(nr) == FEATURE_COLUMNS and all(v == 0.0 for v in nr.values())
    cb = SP.class_balance(df).first()
    assert cb["n_pos"] + cb["n_neg"] == 40
    assert cb["scale_pos_weight"] == pytest.approx(cb["n_neg"] / max(cb["n_pos"], 1))


def test_low_bikes_rule(spark):
    rows = [("A", datetime(2024, 1, 1), 0, b) for b in (0.0, 0.5, 1.0, 5.0, 10.0)]
    df = spark.createDataFrame(rows, "station_id string, obs_ts timestamp_ntz, "
                                     "target_empty_next_hour int, ft_bikes_available double")
    k0 = [r["y_pred"] for r in B.low_bikes_rule(df, 0).orderBy("y_score", ascending=False).collect()]
    k1 = [r["y_pred"] for r in B.low_bikes_rule(df, 1).orderBy("y_score", ascending=False).collect()]
    assert k0 == [1, 0, 0, 0, 0] and k1 == [1, 1, 1, 0, 0]
    scores = sorted(r["y_score"] for r in B.low_bikes_rule(df, 1).collect())
    assert scores == [0.0, 0.5, 0.9, 0.95, 1.0]
    an = B.always_negative(df).collect()
    assert all(r["y_pred"] == 0 and r["y_score"] == 0.0 for r in an)


def test_comparison_table(spark):
    p = _pred(spark, [0, 1, 1, 0], [0, 1, 0, 0], [.1, .9, .4, .3], "a").unionByName(
        _pred(spark, [0, 1, 1, 0], [1, 1, 1, 1], [.5, .5, .5, .5], "b"))
    t = M.comparison_table(M.classification_metrics(p))
    assert set(t.columns) == {"metric", "a", "b"} and t.count() == 7


def test_unknown_bikes_have_no_rule_score(spark):
    from pyspark.sql import functions as F

    from dockwatch.ml.baseline import low_bikes_score

    df = spark.createDataFrame([(None,), (0.0,), (5.0,), (20.0,)], "bikes double")
    got = [r[0] for r in df.select(low_bikes_score(F.col("bikes"), F.lit(10.0))).collect()]
    assert got == [None, 1.0, 0.5, 0.0]


def test_all_metrics_leave_out_unscored_rows(spark):
    known = [("m", 1, 1, .9), ("m", 0, 0, .1), ("m", 1, 0, .4), ("m", 0, 1, .6)]
    odd = [("m", 1, 0, None), ("m", 0, None, None), ("m", None, 1, .5), ("none", 1, 0, None)]
    schema = "model string, y_true int, y_pred int, y_score double"
    got = {r["model"]: r.asDict() for r in M.classification_metrics(spark.createDataFrame(known + odd, schema)).collect()}
    want = M.classification_metrics(spark.createDataFrame(known, schema)).first().asDict()
    assert want["unscored"] == 0 and got["m"] == {**want, "unscored": 3}
    assert got["none"]["unscored"] == 1 and got["none"]["log_loss"] is None and got["none"]["tp"] is None


@pytest.mark.parametrize("ranges", [None, 1, 5, 40])
@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_match_a_plain_scan(spark, ranges, descending):
    from dockwatch.operators.ranks import running_sums

    rnd = random.Random(1)
    rows = [(g, v, rnd.choice([None, 1, 2, 5])) for g in ("a", "b", None) for v in rnd.sample(range(1000), 60 if g == "a" else 7)]
    df = spark.createDataFrame(rows, "g string, v int, n long").repartition(4)
    got = {(r.g, r.v): (r.n_before, r.n_total) for r in running_sums(df, "v", ["n"], ["g"], descending, ranges).collect()}
    assert len(got) == len(rows)
    for g, v, _ in rows:
        own = [(w, n or 0) for h, w, n in rows if h == g]
        assert got[(g, v)] == (sum(n for w, n in own if (w > v if descending else w < v)), sum(n for _, n in own))


def test_percentiles_over_all_rows_use_no_single_window(spark):
    from dockwatch.operators.percentiles import percentiles_from_hist

    values = sorted(random.Random(9).choices(range(50), k=333))
    hist = spark.createDataFrame([(v,) for v in values], "v int").groupBy("v").count()
    out = percentiles_from_hist(hist, "v", "count", [0.25, 0.5, 0.9])
    for p, name in ((0.25, "p25"), (0.5, "p50"), (0.9, "p90")):
        k = p * (len(values) - 1)
        lo, hi = values[int(k)], values[-int(-k // 1)] if k % 1 else values[int(k)]
        assert out.first()[name] == pytest.approx(lo + (k % 1) * (hi - lo))
    assert percentiles_from_hist(hist.limit(0), "v", "count", [0.5]).first()["p50"] is None
