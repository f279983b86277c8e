"""The registered corpus queries: SQL where there is some, and the pipeline's stages."""

import pytest

import corpus_pipeline
from casemill.llm import registry
from tools.check_oracle import as_rows, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_sql_agrees(spark, name):
    df = registry.queries()[name](spark, FOLDER)
    cursor = connect(FOLDER).execute(registry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert as_rows(df.columns, df.collect()) == as_rows(names, cursor.fetchall())


def test_thirteen_operators():
    assert {int(n[2:].split("_")[0]) for n in registry.queries()} == set(range(1, 14))


def test_pipeline_keeps_columns_and_shrinks(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns
        assert docs.count() <= rows
    out = corpus_pipeline.run(spark, FOLDER)
    assert {"doc_id", "ids", "round_trip"} <= set(out.columns)
    assert out.where("NOT round_trip").count() == 0 and 0 < out.count() < rows
