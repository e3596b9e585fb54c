"""As-of join: brute force on random rows, one key holding all rows, odd cases, plan shape."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from dockwatch.operators.asof import asof_join

LEFT = "k string, t long, tag int"
RIGHT = "k string, rt long, em int, v double, w string"


def plain(left, right, offsets, how):
    out = []
    for k, t, tag in left:
        row = [k, t, tag]
        for o in offsets:
            ok = [r for r in right if k is not None and t is not None and r[0] == k and r[1] is not None and r[1] <= t - o]
            best = max(ok, key=lambda r: (r[1], r[2]), default=None)
            row += [best[1], best[3], best[4]] if best else [None] * 3
        if how == "left" or row[3] is not None:
            out.append(tuple(row))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(2)
    right = [(rnd.choice("abcd"), t, em, rnd.choice([None, rnd.random()]), f"w{t}")
             for em, t in enumerate(rnd.choices(range(-300, 700), k=250))]
    right += [("a", 50, 1000, None, "tie"), ("a", 50, 999, 1.0, "loses"), (None, 5, 1, 1.0, "x"), ("a", None, 1, 1.0, "y")]
    left = [(rnd.choice("abcde"), rnd.randint(-400, 900), i) for i in range(120)]
    left += [("a", 50, -1), ("a", 49, -2), ("a", 50, -1), (None, 60, -3), ("b", None, -4)]
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("slice_us", [1, 7, 100, 10_000])
def test_equals_brute_force_for_any_slice(spark, rows, how, slice_us):
    left, right = rows
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "k", "t", "rt", ["v", "w"],
                    offsets_us=(0, 13), tie_breakers=["em"], how=how, slice_us=slice_us)
    assert got.columns == ["k", "t", "tag", "rt", "v", "w", "rt_13", "v_13", "w_13"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(left, right, (0, 13), how)


def test_one_key_holding_all_rows_is_split(spark):
    n, step = 40_000, 100
    right = spark.range(n).select(F.lit("hot").alias("k"), F.col("id").alias("rt"), (F.col("id") * 2).cast("double").alias("v"))
    left = spark.range(0, n, 7).select(F.lit("hot").alias("k"), (F.col("id") + 3).alias("t"))
    got = asof_join(left, right, "k", "t", "rt", ["v"], slice_us=step)
    assert got.where("rt <> least(t, 39999) OR v <> 2 * rt").count() == 0
    assert got.count() == len(range(0, n, 7))
    # rows of the hot key are spread over the tasks of the local match
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")  # which would put so few rows together again
    parts = got.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
    spark.conf.set(name, "true")
    assert len(parts) >= 4 and max(r["count"] for r in parts) < 0.5 * got.count()


def test_windows_over_raw_rows_are_keyed_by_slice(spark, rows):
    left, right = rows
    got = asof_join(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "k", "t", "rt", ["v"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"windowspecdefinition\((.*?), __(slice|k)#\d+L ASC", plan)
    assert sorted(w[1] for w in windows) == ["k", "slice"]
    # the window ordered by the row's own time is partitioned by slice, the other one orders the slices of a key
    (raw,) = [w[0] for w in windows if w[1] == "k"]
    assert "__slice#" in raw


def test_two_keys_and_empty_sides(spark):
    left = spark.createDataFrame([("a", 1, 5), ("a", 2, 5)], "k string, j int, t long")
    right = spark.createDataFrame([("a", 1, 4, 1.0), ("a", 2, 6, 2.0)], "k string, j int, rt long, v double")
    got = asof_join(left, right, ["k", "j"], "t", "rt", ["v"], how="left", prefix="p_")
    assert sorted(map(tuple, got.collect())) == [("a", 1, 5, 4, 1.0), ("a", 2, 5, None, None)]
    assert got.columns[-2:] == ["p_rt", "p_v"]
    assert asof_join(left.limit(0), right, ["k", "j"], "t", "rt", ["v"]).count() == 0
    assert asof_join(left, right.limit(0), ["k", "j"], "t", "rt", ["v"], how="left").where("v IS NULL").count() == 2
    with pytest.raises(ValueError):
        asof_join(left, right, ["k", "j"], "t", "rt", ["v"], how="outer")
