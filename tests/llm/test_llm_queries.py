"""The registered queries: SQL, plans, held-out accuracy, and the pipeline."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from reviewlab.llm import queries

SF = "/root/testdata/sf0.001"
NATIVE = ["op2_quality_rules", "op3_licenses", "op4_line_dedup"]


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_llm_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = queries.RUNS[name](spark, SF)
    relation = con.sql(queries.SQL[name])
    at = [relation.columns.index(c) for c in df.columns]
    want = sorted(([r[i] for i in at] for r in relation.fetchall()), key=repr)
    assert sorted((list(r) for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, name):
    plan = queries.RUNS[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"PythonUDF|InPandas|InArrow|ArrowEval|BatchEvalPython", plan)


def test_every_operator_is_registered():
    numbers = {int(m[1]) for n in entry.queries() if (m := re.match(r"op(\d+)_", n))}
    assert numbers == set(range(1, 11)) and "pipeline" in entry.queries()


def test_classifier_is_right_about_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    scored = queries.RUNS["op8_quality_model"](spark, sf).filter("held_out")
    rows = scored.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows) > 0


def test_pipeline_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        rows = docs.collect()
        assert 0 < len(rows) <= n
        n = len(rows)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
            docs = spark.createDataFrame(rows, docs.schema)
    assert {r.doc_id for r in rows} == {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()}


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
