"""Written datasets: days as partitions, order, summary in the footers."""

from __future__ import annotations

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from dockwatch.plans.dataset import build_dataset
from dockwatch.reports import diagnose as G
from dockwatch.reports.validation import dataset_summary, validate_dataset
from dockwatch.settings import DATASET_COLUMNS, Settings
from dockwatch.sources.artifacts import load_dataset, read_summary, write_dataset, written_summary


@pytest.fixture(scope="module")
def written(spark, random_readings, tmp_path_factory):
    ds = build_dataset(random_readings, Settings(min_forward_rows=10)).cache()
    return ds, write_dataset(ds, str(tmp_path_factory.mktemp("out")), spark, upstream="here")


def test_written_rows_equal_the_built_ones(spark, written):
    ds, path = written
    back = load_dataset(spark, path)
    assert back.columns == DATASET_COLUMNS and validate_dataset(back)[0] == validate_dataset(ds)[0]
    assert back.exceptAll(ds).count() == 0 and back.count() == ds.count() > 0


def test_a_day_is_a_partition(spark, written):
    ds, path = written
    days = sorted({r.obs_ts.date() for r in ds.select("obs_ts").collect()})
    assert len(days) == 3
    start = max(r.obs_ts for r in ds.collect() if r.obs_ts.date() == days[1]).replace(hour=6, minute=0)
    end = start + timedelta(hours=6)
    one = G.inspect_dataset(load_dataset(spark, path, start, end), "R1", start, end)
    files = {r.f for r in one.select(F.input_file_name().alias("f")).collect()}
    assert files and all(f"obs_date={days[1]}" in f for f in files)
    plan = one._jdf.queryExecution().executedPlan().toString()
    bounds = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert ">=" in bounds and "<=" in bounds and "EqualTo(station_id,R1)" in plan
    want = [r for r in ds.collect() if r.station_id == "R1" and start <= r.obs_ts <= end]
    assert sorted(one.collect()) == sorted(want) and 0 < len(want) < ds.count()


def test_files_are_in_order(spark, written):
    _, path = written
    files = sorted(load_dataset(spark, path).inputFiles())
    rows = [(r.obs_ts, r.station_id) for f in files for r in spark.read.parquet(f).select("obs_ts", "station_id").collect()]
    assert len(files) >= 3 and rows == sorted(rows)


def test_summary_comes_from_the_footer(spark, written):
    ds, path = written
    said = read_summary(spark, path)
    assert said["upstream_path"] == "here" and said["row_count"] == ds.count()
    assert written_summary(spark, path).collect() == dataset_summary(ds).select(*written_summary(spark, path).columns).collect()


def test_nothing_is_written_for_an_empty_dataset(spark, written, tmp_path):
    assert write_dataset(written[0].limit(0), str(tmp_path), spark) is None
