"""The pipeline keeps clean documents, drops the rest, and packs what is left."""

from __future__ import annotations

import corpus_pipeline as P
from dockwatch.llm.shared import Scratch, components, read_table

SF = "/root/testdata/sf0.01"


def test_stages_over_the_small_tables(spark):
    docs = read_table(spark, SF, "documents")
    labels = {r.doc_id: r for r in read_table(spark, SF, "labels").collect()}
    scratch, now = Scratch(spark, "test"), docs
    for name, stage in P.STAGES[:-1]:
        before = {r.doc_id for r in now.select("doc_id").collect()}
        now = scratch.table(stage(spark, now, SF))
        assert now.columns == docs.columns
        gone = before - {r.doc_id for r in now.select("doc_id").collect()}
        if name == "quality":
            assert sum(labels[i].quality for i in gone if i in labels) <= 0.02 * len(before)
            assert sum(1 - labels[i].quality for i in gone if i in labels) >= 45
        if name == "toxicity":
            assert sum(1 - labels[i].toxic for i in gone if i in labels) <= 0.02 * len(before)
    packed = P.STAGES[-1][1](spark, now, SF)
    assert packed.select("doc_id").distinct().count() == now.count()


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, j) for j in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "cc")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[j] == 100 for j in range(100, 160)) and got[201] == 200
