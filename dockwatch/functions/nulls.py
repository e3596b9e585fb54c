"""Null-aware arithmetic helpers (ANSI mode raises on division by zero)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """num / NULLIF(den, 0) as double; NULL when either side is NULL."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def nsum(*cols: Column) -> Column:
    """SQL SUM semantics over partial sums: NULL only when every part is NULL."""
    any_present = reduce(lambda a, b: a | b, [c.isNotNull() for c in cols])
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in cols])
    return F.when(any_present, total)


def nmin(*cols: Column) -> Column:
    """Minimum ignoring NULLs (NULL when all are NULL)."""
    return F.least(*cols) if len(cols) > 1 else cols[0]


def nmax(*cols: Column) -> Column:
    return F.greatest(*cols) if len(cols) > 1 else cols[0]


def is_missing(col: Column) -> Column:
    """NULL, or NaN for floating columns (pandas' isnull on a double column)."""
    return col.isNull() | F.isnan(col)
