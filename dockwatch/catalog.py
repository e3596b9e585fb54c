"""Registered queries (Spark) and their DuckDB oracles, keyed by name.

Every query reads the driver's tables (readings derived from ``events``), so
its work grows with the scale factor.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockwatch import oracles as O
from dockwatch.functions.timeexpr import from_micros
from dockwatch.plans import dataset as D
from dockwatch.settings import Settings
from dockwatch.sources.readings import readings_for

QUERY_SETTINGS = Settings(min_forward_rows=30)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn
    return deco


def queries() -> dict[str, Query]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLES)


def _load_all() -> None:
    # query groups register themselves on import
    from dockwatch import catalog_ml, catalog_model, catalog_more, catalog_serve, catalog_stream  # noqa: F401


S = QUERY_SETTINGS


@register("readings_scan", O.with_base(S, "SELECT * FROM readings"))
def q_readings_scan(spark: SparkSession, d: str) -> DataFrame:
    return readings_for(spark, d)


@register("obs_grid", O.with_base(S, "SELECT station_id, obs_ts FROM grid"))
def q_obs_grid(spark: SparkSession, d: str) -> DataFrame:
    g = D.grid_rows(readings_for(spark, d), S)
    return g.select("station_id", from_micros("obs_us").alias("obs_ts"))


@register("forward_label", O.with_base(S, "SELECT * FROM fwd"))
def q_forward_label(spark: SparkSession, d: str) -> DataFrame:
    return D.forward_label(readings_for(spark, d), S)


@register("training_dataset", O.with_dataset(S, "SELECT * FROM dataset"))
def q_training_dataset(spark: SparkSession, d: str) -> DataFrame:
    return D.build_dataset(readings_for(spark, d), S, plan="bucket")


@register("training_dataset_union", O.with_dataset(S, "SELECT * FROM dataset"))
def q_training_dataset_union(spark: SparkSession, d: str) -> DataFrame:
    return D.build_dataset(readings_for(spark, d), S, plan="union")


def _register_interval(minutes: int) -> None:
    s = Settings(min_forward_rows=30, sample_interval_min=minutes)

    @register(f"training_dataset_{minutes}m", O.with_dataset(s, "SELECT * FROM dataset"))
    def q_training_dataset_interval(spark: SparkSession, d: str) -> DataFrame:
        """The dataset on another grid: buckets of the common divisor of the interval and all offsets."""
        return D.build_dataset(readings_for(spark, d), s)


for _minutes in (7, 10, 30):
    _register_interval(_minutes)


@register("dataset_row_count", O.with_dataset(S, "SELECT COUNT(*) AS row_count FROM dataset"))
def q_dataset_row_count(spark: SparkSession, d: str) -> DataFrame:
    return D.build_dataset(readings_for(spark, d), S).agg(F.count(F.lit(1)).alias("row_count"))
