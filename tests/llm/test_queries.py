"""Registered queries and the pipeline."""

import os
import sys

import __spark_entry__
import corpus_pipeline
import pytest

from lodestat.llm import registered

from conftest import FOLDER

sys.path.append(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_names():
    assert [n.split("_")[0] for n in registered.QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert {*registered.QUERIES, "pipeline"} <= set(__spark_entry__.queries()) and set(registered.SQL) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("name", sorted(registered.SQL))
def test_matches_sql(spark, name):
    import oracle

    assert oracle.compare(spark, oracle.connect(FOLDER), name, registered.QUERIES[name], registered.SQL[name], FOLDER) == ""


def test_pipeline(spark, table, tmp_path):
    docs, sizes = table, [table.count()]
    seen = [{r["doc_id"]: r["text"] for r in table.select("doc_id", "text").collect()}]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        sizes.append(docs.count())
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == table.columns
            seen.append({r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()})
    assert sizes[1] >= 0.95 * sizes[0] and sizes[2] < sizes[1] and sizes[5] == sizes[4]
    last = {r["doc_id"]: r["decoded"] for r in docs.collect()}
    assert last == seen[4]
    for d in seen[2]:
        assert seen[2][d] == seen[0][d]


def test_pipeline_on_awkward_rows(spark, edge, empty, tmp_path):
    for name, rows in (("edge", edge), ("twice", edge.unionByName(edge)), ("none", empty)):
        docs = rows.select("doc_id", "text", "lang", "source", "n_chars")
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}{number}")
            docs = spark.read.parquet(f"{tmp_path}/{name}{number}")
        assert (docs.count() == 0) == (name == "none")
