"""Jobs: scoring, look-back index, the chain with its run table."""

from __future__ import annotations

from datetime import timedelta

import pytest

from dockwatch.jobs import cli
from dockwatch.jobs.chain import run_chain
from dockwatch.ml.scorers import RuleScorer
from dockwatch.plans.scoring import score_requests
from dockwatch.settings import Settings
from dockwatch.sources.runs import newest_run, publish_run, runs

from .conftest import BASE


@pytest.fixture(autouse=True)
def same_session(monkeypatch, spark):
    monkeypatch.setattr(cli, "_spark", lambda args: spark)


@pytest.fixture(scope="module")
def tables(spark, readings, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("jobs"))
    readings.write.parquet(f"{base}/readings")
    req = [(s, BASE + timedelta(minutes=m)) for s in ("S1", "S2", "S3", "S9") for m in (40, 95)]
    spark.createDataFrame(req, "station_id string, obs_ts timestamp_ntz").write.parquet(f"{base}/requests")
    return base


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_score_and_index_jobs(spark, readings, tables):
    assert cli.main(["--readings", f"{tables}/readings", "index", "--out", f"{tables}/index"]) == 0
    assert spark.read.parquet(f"{tables}/index").count() == 3
    args = ["--readings", f"{tables}/readings", "score", "--requests", f"{tables}/requests", "--out", f"{tables}/scores"]
    assert cli.main([*args, "--index", f"{tables}/index"]) == 0
    want = score_requests(readings, spark.read.parquet(f"{tables}/requests"), RuleScorer(max_bikes=15.0))
    assert _rows(spark.read.parquet(f"{tables}/scores")) == _rows(want) and want.count() == 8


def test_score_live_job(spark, tables):
    args = ["--readings", f"{tables}/readings", "score-live", "--requests", f"{tables}/requests", "--out", f"{tables}/live",
            "--checkpoint", f"{tables}/ck", "--max-bikes", "15", "--delay", "30 minutes", "--once"]
    assert cli.main(args) == 0
    live = spark.read.parquet(f"{tables}/live").drop("epoch")
    assert live.count() == 8  # the last reading is at minute 179, so the watermark passes minute 95
    assert _rows(live) == _rows(spark.read.parquet(f"{tables}/scores").select(*live.columns))


def test_chain_publishes_complete_runs_only(spark, random_readings, tmp_path, capsys):
    root, s = str(tmp_path), Settings(min_forward_rows=30)
    with pytest.raises(FileNotFoundError):
        newest_run(spark, root)
    # unknown bikes make features unknown that must not be
    failed = run_chain(spark, random_readings, root, s, max_iter=2, rid="20240101_000000")
    assert not failed["published"] and failed["reason"] == "validation" and runs(spark, root).count() == 0
    known = random_readings.where("avg_bikes_available IS NOT NULL AND avg_availability_ratio IS NOT NULL")
    empty = run_chain(spark, random_readings.limit(0), root, s, max_iter=2)
    assert not empty["published"] and runs(spark, root).count() == 0
    done = run_chain(spark, known, root, s, max_iter=2, rid="20240102_000000")
    assert done["published"] and newest_run(spark, root)["model"] == done["model"]
    publish_run(spark, root, run_ts="20230101_000000", model="older")
    assert newest_run(spark, root)["run_ts"] == "20240102_000000" and runs(spark, root).count() == 2
    # evaluate and triage need no paths
    assert cli.main(["evaluate", "--runs", root]) == 0
    assert '"status": "MATCH"' in capsys.readouterr().out
    known.write.parquet(f"{root}/readings")
    at = known.where("avg_capacity >= 20").agg({"window_start": "max"}).first()[0]
    assert cli.main(["--readings", f"{root}/readings", "triage", "--runs", root, "--at", at.isoformat()]) == 0
    with pytest.raises(ValueError):
        publish_run(spark, root, nothing="x")
