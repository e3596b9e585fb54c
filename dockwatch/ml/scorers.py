"""Scorers: map a features frame to the same frame plus ``raw_score``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.ml.baseline import low_bikes_score


class RuleScorer:
    """The low-bikes rule as a scorer: 1 - bikes / max(max bikes, 1), clipped to
    [0, 1]. Deterministic, so scoring and triage with it have SQL oracles.

    ``max_bikes`` is the largest bike count; without one it is that of the rows scored together, so a row's score
    depends on the others. ``fitted`` fixes it, as a stream needs."""

    def __init__(self, name: str = "low_bikes_rule", max_bikes: float | None = None):
        self.name, self.max_bikes = name, max_bikes

    @classmethod
    def fitted(cls, rows: DataFrame, column: str = "avg_bikes_available", name: str = "low_bikes_rule") -> RuleScorer:
        """The rule with the largest value of ``column`` (0 if there is none)."""
        return cls(name, float(rows.agg(F.max(column)).first()[0] or 0.0))

    def score(self, features: DataFrame) -> DataFrame:
        if self.max_bikes is not None:
            return features.withColumn("raw_score", low_bikes_score(F.col("ft_bikes_available"), F.lit(self.max_bikes)))
        mx = F.broadcast(features.agg(F.max("ft_bikes_available").alias("__mx")))
        return features.crossJoin(mx).withColumn(
            "raw_score", low_bikes_score(F.col("ft_bikes_available"), F.col("__mx"))).drop("__mx")


class ModelScorer:
    """A fitted boosted-tree pipeline (see ``ml.model``)."""

    def __init__(self, model, name: str = "gbt"):
        self.model, self.name = model, name

    def score(self, features: DataFrame) -> DataFrame:
        from dockwatch.ml.model import predict_proba
        return predict_proba(self.model, features)
