"""Readings source: the minute-level station table, and an adapter that derives
it from the generic ``events`` table so every query scales with the inputs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockwatch.functions.timeexpr import MINUTE_US, floor_to, from_micros, micros, ts_literal_micros

READINGS_TABLE = "raw_station_metrics_1min"

READINGS_SCHEMA = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("window_end", T.TimestampNTZType()),
    T.StructField("avg_bikes_available", T.DoubleType()),
    T.StructField("avg_docks_available", T.DoubleType()),
    T.StructField("avg_capacity", T.DoubleType()),
    T.StructField("avg_availability_ratio", T.DoubleType()),
    T.StructField("low_availability_events", T.LongType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("emitted_at", T.TimestampNTZType()),
])

# Columns any feature, label or report reads; the scan is pruned to these.
USED_COLUMNS = [
    "station_id", "window_start", "emitted_at", "avg_bikes_available",
    "avg_docks_available", "avg_capacity", "avg_availability_ratio",
    "low_availability_events", "event_count",
]


def load_readings(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read the readings table with an explicit schema (no inference)."""
    return spark.read.format(fmt).schema(READINGS_SCHEMA).load(path).select(*USED_COLUMNS)


# Fixed values of the events adapter (see FIXTURES.md, F5).
ADAPTER_BASE = datetime(2024, 1, 1)
ADAPTER_TIME_SQUEEZE = 20
ADAPTER_USERS_PER_STATION = 30


def readings_from_events(events: DataFrame) -> DataFrame:
    """One-minute tumbling aggregate of ``events`` shaped as station readings.

    station = user_id div 30; event time squeezed 20x towards 2024-01-01; bikes
    are whole numbers and capacities powers of two so every sum is exact.
    One hash aggregate (partial + final) keyed by (station, minute).
    """
    base = ts_literal_micros(ADAPTER_BASE)
    us = micros("ts") - F.lit(base)
    squeezed = F.lit(base) + F.expr(f"div(x - pmod(x, {ADAPTER_TIME_SQUEEZE}), {ADAPTER_TIME_SQUEEZE})")
    ev = (
        events.select("ts", "user_id", "value")
        .withColumn("x", us)
        .select(
            F.expr(f"user_id div {ADAPTER_USERS_PER_STATION}").alias("st"),
            floor_to(squeezed, MINUTE_US).alias("ws_us"),
            F.round(F.col("value") * 100).cast("long").alias("cents"),
        )
    )
    g = ev.groupBy("st", "ws_us").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("cents").alias("cents"),
    )
    moh = F.pmod(F.expr(f"div(ws_us, {MINUTE_US})"), F.lit(60))
    st5 = F.pmod(F.col("st"), F.lit(5))
    cap = (F.when(st5 == 3, F.lit(4.0))
           .when((st5 == 4) & (F.pmod(moh, F.lit(10)) == 0), F.lit(4.0))
           .otherwise(F.lit(64.0)))
    bikes = F.least(F.expr("div(cents, 100 * n)").cast("double"), cap)
    ws = from_micros("ws_us")
    we = from_micros(F.col("ws_us") + F.lit(MINUTE_US))
    out = (
        g.select(
            F.col("st").cast("string").alias("station_id"),
            ws.alias("window_start"),
            we.alias("window_end"),
            bikes.alias("avg_bikes_available"),
            cap.alias("avg_capacity"),
            moh.alias("moh"),
            F.col("n"),
        )
        .select(
            "station_id", "window_start", "window_end", "avg_bikes_available",
            (F.col("avg_capacity") - F.col("avg_bikes_available")).alias("avg_docks_available"),
            "avg_capacity",
            F.when(F.pmod(F.col("moh"), F.lit(7)) == 0, F.lit(None).cast("double"))
            .otherwise(F.col("avg_bikes_available") / F.col("avg_capacity"))
            .alias("avg_availability_ratio"),
            F.when(F.col("avg_bikes_available") / F.col("avg_capacity") < 0.2, F.col("n"))
            .otherwise(F.lit(0).cast("long")).alias("low_availability_events"),
            F.col("n").alias("event_count"),
            F.col("window_end").alias("emitted_at"),
        )
    )
    return out.select(*[f.name for f in READINGS_SCHEMA.fields])


def readings_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings derived from ``{sf_dir}/events.parquet``."""
    return readings_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


# DuckDB SQL of the same adapter, used by the oracles.
READINGS_ORACLE_CTE = f"""
readings AS (
  SELECT CAST(st AS VARCHAR) AS station_id,
         make_timestamp(ws_us) AS window_start,
         make_timestamp(ws_us + 60000000::BIGINT) AS window_end,
         bikes AS avg_bikes_available,
         cap - bikes AS avg_docks_available,
         cap AS avg_capacity,
         CASE WHEN moh % 7 = 0 THEN NULL ELSE bikes / cap END AS avg_availability_ratio,
         CASE WHEN bikes / cap < 0.2 THEN n ELSE 0 END::BIGINT AS low_availability_events,
         n::BIGINT AS event_count,
         make_timestamp(ws_us + 60000000::BIGINT) AS emitted_at
  FROM (
    SELECT st, ws_us, n, cap, moh,
           LEAST(CAST(cents // (100 * n) AS DOUBLE), cap) AS bikes
    FROM (
      SELECT st, ws_us, n, cents,
             ((ws_us // 60000000::BIGINT) % 60) AS moh,
             CASE WHEN st % 5 = 3 THEN 4.0::DOUBLE
                  WHEN st % 5 = 4 AND ((ws_us // 60000000::BIGINT) % 60) % 10 = 0 THEN 4.0::DOUBLE
                  ELSE 64.0::DOUBLE END AS cap
      FROM (
        SELECT user_id // {ADAPTER_USERS_PER_STATION} AS st,
               sq - (sq % 60000000::BIGINT) AS ws_us,
               COUNT(*) AS n,
               SUM(CAST(round(value * 100) AS BIGINT)) AS cents
        FROM (
          SELECT user_id, value,
                 {ts_literal_micros(ADAPTER_BASE)}::BIGINT
                   + (epoch_us(ts) - {ts_literal_micros(ADAPTER_BASE)}::BIGINT) // {ADAPTER_TIME_SQUEEZE} AS sq
          FROM events
        ) e
        GROUP BY 1, 2
      ) g
    ) h
  ) k
)"""
