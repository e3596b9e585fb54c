"""Bounded labelled samples, and features computed over whole texts."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockwatch.llm.shared import byte_slices

#: Most labelled (and, where asked for, unlabelled) rows a classifier is fitted on.
SAMPLE_ROWS = 20_000
FEATURES = "_llm_features"
SLICE_BYTES = 4 << 20


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def labelled_ids(labels: DataFrame, label: str, folds: int, held_out: int, rows: int) -> DataFrame:
    """At most ``rows`` (doc_id, y), those of the smallest hashes, outside the held-out fold. Ids
    with a null label are left out; one with several labels takes the larger."""
    ok = (fold("doc_id", folds) != held_out) & F.col(label).isNotNull()
    ids = labels.where(ok).groupBy("doc_id").agg(F.max(F.col(label).cast("double")).alias("y"))
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def unlabelled_ids(docs: DataFrame, folds: int, held_out: int, rows: int) -> DataFrame:
    """At most ``rows`` distinct doc_ids of ``docs``, those of the smallest hashes, outside the held-out fold."""
    ids = docs.where(fold("doc_id", folds) != held_out).select("doc_id").distinct()
    return ids.orderBy(F.xxhash64("doc_id", F.lit(1)), "doc_id").limit(rows)


def with_features(df: DataFrame, text: str, make: Callable[[list[str]], np.ndarray], keep: list[str]) -> DataFrame:
    """The columns ``keep`` and an array of doubles made of each whole text (null: empty)."""

    def run(batches):
        for whole in batches:
            for b in byte_slices(whole, "_llm_text", SLICE_BYTES):
                x = make(b.column("_llm_text").to_pylist()).astype(np.float64)
                off = pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32())
                cols = [b.column(c) for c in keep] + [pa.ListArray.from_arrays(off, pa.array(x.reshape(-1)))]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, FEATURES])

    src = df.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_llm_text"))
    schema = T.StructType([*(df.schema[c] for c in keep), T.StructField(FEATURES, T.ArrayType(T.DoubleType()))])
    return src.mapInArrow(run, schema)
