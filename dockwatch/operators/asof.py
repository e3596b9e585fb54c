"""Generic as-of (point-in-time) join, cut into slices of time.

Spark has no public as-of join. For each left row we want the newest right row with
``right_time <= left_time - offset`` (per key). A window over all rows of a key would put a hot key
into one task, so time is cut into slices of ``slice_us`` and the work is keyed by (key, slice):

1. newest right row of each (key, slice): a grouped maximum, reduced before its shuffle;
2. prefix scan: the newest row of any earlier slice, carried to each slice that a left row looks into. This
   window runs over slices, at most one row per key and slice, never over raw rows;
3. local match: left rows, the right rows of the same slice and the carried row meet in one window per
   (key, slice).

A right row is one orderable struct led by its time (then the tie-breakers); ``max(struct)`` picks the newest.
Each offset is a pass of its own, because its rows look into other slices.

For grid-aligned workloads the bucket plans in ``plans.dataset`` are cheaper; this is the general form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockwatch.functions.timeexpr import HOUR_US, floor_to, micros

DEFAULT_SLICE_US = 6 * HOUR_US
UNB = Window.unboundedPreceding


def _as_micros(df: DataFrame, col: str) -> Column:
    dt = dict(df.dtypes)[col]
    if dt.startswith("timestamp"):
        return micros(F.col(col)) if dt == "timestamp_ntz" else F.unix_micros(F.col(col))
    return F.col(col).cast("long")


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    left_time: str,
    right_time: str,
    value_cols: Sequence[str],
    offsets_us: Sequence[int] = (0,),
    tie_breakers: Sequence[str] = (),
    how: str = "inner",
    prefix: str = "",
    slice_us: int = DEFAULT_SLICE_US,
) -> DataFrame:
    """Left rows with, per offset ``o``, the newest right row at or before
    ``left_time - o``.

    Output: left columns, then ``{prefix}{col}`` for offset 0 (or
    ``{prefix}{col}_{o}`` for other offsets) and ``{prefix}{right_time}``.
    ``how='inner'`` drops left rows without a match at the first offset; ``'left'``
    keeps them with NULLs. Ties on time are broken by ``tie_breakers`` (largest wins).

    Left rows that occur twice stay two rows. A left row with a NULL key or time matches nothing, nor does a
    right row with one. ``slice_us`` cuts the work, not the result: at most the rows of one key and slice (and the
    slices of one key) come to one task.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    keys = [on] if isinstance(on, str) else list(on)
    rec = F.struct(
        _as_micros(right, right_time).alias("__t"),
        *[F.col(c).alias(f"__tb{i}") for i, c in enumerate(tie_breakers)],
        *[F.col(c).alias(c) for c in [right_time, *value_cols]],
    )
    r = right.select(*keys, _as_micros(right, right_time).alias("__k"), rec.alias("__rec"))
    r = r.where(F.col("__k").isNotNull()).withColumn("__slice", floor_to("__k", slice_us))
    newest = r.groupBy(*keys, "__slice").agg(F.max("__rec").alias("__rec"))
    lcols = list(left.columns)
    out = left.withColumn("__lt", _as_micros(left, left_time))
    for o in offsets_us:
        out = _match(out, r, newest, keys, int(o), slice_us)
    sel = [F.col(c) for c in lcols]
    for o in offsets_us:
        suffix = "" if o == 0 else f"_{o}"
        for c in [right_time, *value_cols]:
            sel.append(F.col(f"__m{o}")[c].alias(f"{prefix}{c}{suffix}"))
    if how == "inner":
        out = out.filter(F.col(f"__m{offsets_us[0]}").isNotNull())
    return out.select(*sel)


def _match(left: DataFrame, right: DataFrame, newest: DataFrame, keys: list[str], offset: int, slice_us: int) -> DataFrame:
    """``left`` (with ``__lt``) and ``__m{offset}``: the newest right record at or before ``__lt - offset``."""
    name = f"__m{offset}"
    lft = left.withColumn("__k", F.col("__lt") - F.lit(offset)).withColumn("__slice", floor_to("__k", slice_us))
    whole = F.lit(True)
    for k in [*keys, "__k"]:
        whole = whole & F.col(k).isNotNull()
    none = lft.where(~whole).drop("__k", "__slice")
    lft = lft.where(whole)

    # prefix scan over the slices that hold right rows or are asked for
    asked = lft.select(*keys, "__slice").distinct()
    slices = newest.join(asked.select(*keys).distinct(), keys, "left_semi").withColumn("__asked", F.lit(False))
    slices = slices.unionByName(asked.withColumn("__asked", F.lit(True)), allowMissingColumns=True)
    earlier = Window.partitionBy(*keys).orderBy("__slice").rangeBetween(UNB, -1)
    carried = slices.select(*keys, "__slice", "__asked", F.max("__rec").over(earlier).alias("__rec"))
    carried = carried.where(F.col("__asked") & F.col("__rec").isNotNull()).select(
        *keys, "__slice", "__rec", F.col("__slice").alias("__k"))

    # local match: the carried record stands at the slice's start, older than any of the slice's own
    local = right.join(asked, [*keys, "__slice"], "left_semi").unionByName(carried)
    u = lft.withColumn("__is_left", F.lit(True)).unionByName(local.withColumn("__is_left", F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy(*keys, "__slice").orderBy("__k").rangeBetween(UNB, 0)
    got = u.select(*left.columns, "__is_left", F.max("__rec").over(w).alias(name)).where("__is_left").drop("__is_left")
    return got.unionByName(none, allowMissingColumns=True)
