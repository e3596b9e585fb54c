"""Corpus pipeline: quality, toxicity, near duplicates, packing. Part of the llm subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockwatch.llm.jaccard import drop_near_duplicates
from dockwatch.llm.packing import pack_documents, tokenizer_path
from dockwatch.llm.quality import drop_low_quality
from dockwatch.llm.shared import Scratch, read_table
from dockwatch.llm.toxicity import drop_toxic


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_low_quality(docs, read_table(spark, sf_dir, "labels"))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, lambda: tokenizer_path("word_bpe_49k.json"))


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("packing", packing)]

#: Two fitted classifiers and a tokenizer: SQL can't express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again by the next."""
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.table(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
