"""Station look-back index: newest, first and last reading per station and day.

As-of look-ups reach back without bound: a station that was silent for a month still has a newest
reading. The index answers them from a table of at most one row per station and day, so that scoring and
triage scan only the day or two of readings that their windows need. A day's rows never change once
the day is over; a job appends the days since its last run (``station_days`` of those readings) to the
table and hands it in as ``index``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockwatch.functions.timeexpr import DAY_US, MINUTE_US, floor_to, from_micros
from dockwatch.operators.newest import newest_aggs, newest_key, newest_record
from dockwatch.operators.rollup import REC_VALUES, with_micros

# Raw readings are reduced per quarter of an hour first: one hash aggregate, whatever a day holds.
INDEX_STEP_US = 15 * MINUTE_US


def day_micros(us: Column) -> Column:
    return floor_to(us, DAY_US)


def station_days(readings: DataFrame) -> DataFrame:
    """(station_id, day, first_seen, last_seen, readings, rec): ``day`` is the micros of its start,
    ``rec`` the day's newest reading."""
    r = with_micros(readings).withColumn("b", floor_to("ts_us", INDEX_STEP_US))
    r = r.withColumn("k", newest_key(F.col("ts_us"), F.col("em_us"), F.col("b"), INDEX_STEP_US))
    g = r.groupBy("station_id", "b").agg(
        F.min("ts_us").alias("lo"), F.max("ts_us").alias("hi"), F.count(F.lit(1)).alias("n"),
        *newest_aggs(F.col("k"), {n: F.col(c) for n, c in REC_VALUES.items()}, "rec"))
    g = g.select("station_id", day_micros(F.col("b")).alias("day"), "lo", "hi", "n",
                 newest_record("rec", tuple(REC_VALUES), F.col("b"), INDEX_STEP_US).alias("rec"))
    return g.groupBy("station_id", "day").agg(
        from_micros(F.min("lo")).alias("first_seen"), from_micros(F.max("hi")).alias("last_seen"),
        F.sum("n").alias("readings"), F.max("rec").alias("rec"))


def newest_before(points: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct ``points (station_id, day)`` with ``old``: the newest reading of any earlier day (NULL if
    none). One window over station-days, not over readings."""
    p = points.select("station_id", "day").distinct()
    days = index.select("station_id", "day", "rec", F.lit(False).alias("asked"))
    days = days.join(p.select("station_id").distinct(), "station_id", "left_semi")
    u = days.unionByName(p.withColumn("asked", F.lit(True)), allowMissingColumns=True)
    w = Window.partitionBy("station_id").orderBy("day").rangeBetween(Window.unboundedPreceding, -1)
    return (u.select("station_id", "day", "asked", F.max("rec").over(w).alias("old"))
            .where("asked").drop("asked"))
