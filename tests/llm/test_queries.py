"""The registered queries against their SQL, and the pipeline's contract."""

import pytest

import corpus_pipeline
from checks.compare import compare
from sparkprep.llm.queries import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    status, _, _, detail = compare(spark, SMALL, name, QUERIES[name], ORACLE[name])
    assert status == "ok", detail


def test_mixing_runs_no_python(spark):
    plan = QUERIES["op6_pfair_mixing"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        left = {r.doc_id for r in docs.select("doc_id").collect()}
        assert left and left <= ids
        ids = left
    mixed = corpus_pipeline.run(spark, SMALL)
    assert {r.doc_id for r in mixed.select("doc_id").collect()} == ids
