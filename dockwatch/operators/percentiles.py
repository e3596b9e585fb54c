"""Exact PERCENTILE_CONT from a value histogram.

``F.percentile`` is exact but keeps every value of a group in one aggregation
buffer. Coverage reports take percentiles of small integer counts, so we first
reduce to a histogram ``(group, value, count)`` (a partial/final hash
aggregate), then interpolate from cumulative counts (``operators.ranks``: no window over a whole
group's values).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwatch.operators.ranks import running_sums


def value_at_rank(value: str, cum: str, k: Column) -> Column:
    """Aggregate: the value at 0-based rank ``k`` (smallest value whose
    cumulative count exceeds k)."""
    return F.min(F.when(F.col(cum) > k, F.col(value)))


def percentiles_from_hist(
    hist: DataFrame,
    value: str,
    count: str,
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    names: Sequence[str] | None = None,
    extra_aggs: Sequence[Column] = (),
) -> DataFrame:
    """Per group: ``PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY value)`` for each p,
    computed as lo + (rn - floor(rn)) * (hi - lo) with rn = p * (N - 1)."""
    names = list(names) if names is not None else [f"p{int(round(p * 100))}" for p in probs]
    gcols = list(group_cols)
    h = running_sums(hist, value, [count], gcols)
    h = h.withColumns({"__cum": F.col(f"{count}_before") + F.col(count), "__n": F.col(f"{count}_total")})
    outs = []
    for p, name in zip(probs, names):
        rn = F.lit(float(p)) * (F.col("__n") - 1).cast("double")
        lo = value_at_rank(value, "__cum", F.floor(rn)).cast("double")
        hi = value_at_rank(value, "__cum", F.ceil(rn)).cast("double")
        frac = F.max(rn - F.floor(rn))
        outs.append((lo + frac * (hi - lo)).alias(name))
    return (h.groupBy(*gcols).agg(*outs, *extra_aggs) if gcols
            else h.agg(*outs, *extra_aggs))
