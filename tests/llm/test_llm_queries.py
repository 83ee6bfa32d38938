"""Registered queries against DuckDB where SQL can say them, and the pipeline end to end."""

import os

import pytest

import corpus_pipeline
from graphloom.llm import queries
from tools.oracle_check import canon, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    frame = queries.QUERIES[name](spark, SF)
    relation = duck(SF).sql(queries.ORACLE_SQL[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    assert canon([tuple(r) for r in frame.collect()], frame.columns) == canon(relation.fetchall(), list(relation.columns))


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        seen.append(docs.count())
    assert 0 < seen[1] < seen[0] and seen[2] == seen[1] and 0 < seen[3] <= seen[2] and seen[4] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r["length"] for r in packed} <= {1 << k for k in range(11)}
    assert sorted(r["sequence_id"] for r in packed) == list(range(len(packed)))
    assert sum(r["doc_tokens"] for r in packed if r["start"] == 0) == sum(len(r["ids"]) // 4 for r in packed)
