"""Run table: which artifacts belong to a complete run.

Every run writes its artifacts under its own run id first and appends one row to ``{root}/runs`` last. Readers go through
the table, so they never see half a run, and a run that failed its validation publishes nothing.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_SCHEMA = "run_ts string, dataset string, model string, metrics string, predictions string, row_count long"


def _table(root: str) -> str:
    return f"{root.rstrip('/')}/runs"


def publish_run(spark: SparkSession, root: str, **row) -> None:
    """Append a complete run: ``run_ts`` (a run id, ordered by time) and the paths of its artifacts."""
    names = [c.split()[0] for c in RUN_SCHEMA.split(", ")]
    if unknown := set(row) - set(names):
        raise ValueError(f"not a column of the run table: {sorted(unknown)}")
    spark.createDataFrame([tuple(row.get(n) for n in names)], RUN_SCHEMA).coalesce(1).write.mode("append").parquet(_table(root))


def runs(spark: SparkSession, root: str) -> DataFrame:
    """All published runs (none: an empty table)."""
    try:
        return spark.read.schema(RUN_SCHEMA).parquet(_table(root))
    except AnalysisException:
        return spark.createDataFrame([], RUN_SCHEMA)


def newest_run(spark: SparkSession, root: str) -> dict:
    """The newest published run; raises FileNotFoundError when there is none."""
    newest = runs(spark, root).agg(F.max_by(F.struct("*"), "run_ts").alias("r")).first()["r"]
    if newest is None:
        raise FileNotFoundError(f"No published run under {root}")
    return newest.asDict()
