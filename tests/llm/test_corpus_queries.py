"""The registered corpus queries over the smallest tables, against DuckDB where SQL can say them."""

import os

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import queries
from compare import TABLES, compare
from gridstats.llm.queries import all_queries
from gridstats.llm.statements import all_statements

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def base():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(all_statements()))
def test_query_equals_statement(spark, base, name):
    result = queries()[name](spark, FOLDER).toArrow().to_pandas(integer_object_nulls=True)
    expected = base.sql(all_statements()[name]).to_arrow_table().to_pandas(integer_object_nulls=True)
    assert compare(result, expected) == ""


@pytest.mark.parametrize("name", sorted(set(all_queries()) - set(all_statements())))
def test_query_has_a_row_per_input_row(spark, name):
    rows = queries()[name](spark, FOLDER)
    if name == "op11_conversation_repair":
        talks = spark.read.parquet(f"{FOLDER}/conversations.parquet")
        assert rows.count() == talks.select("conv_id").distinct().count()
    elif name == "op12_whitening":
        assert rows.count() == 4 * spark.read.parquet(f"{FOLDER}/embeddings.parquet").count()
    elif name == "op9_neighbours":
        ids = spark.read.parquet(f"{FOLDER}/embeddings.parquet").where("vec_id % 20 = 0").count()
        assert rows.select("query_id").distinct().count() == ids
    else:
        assert rows.count() == spark.read.parquet(f"{FOLDER}/documents.parquet").count()


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs.count()
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
        assert docs.count() <= before
        before = docs.count()
    mixed = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert 0 < mixed.count() <= before and mixed.where("taken > 3 * size").count() == 0
