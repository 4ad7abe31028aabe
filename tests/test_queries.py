"""Registered queries against their DuckDB statements, on the smallest test tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import SAME, TABLES, compare
from gridstats.schemas import TABLES as STAR
from gridstats.testbed.queries import STAR_KEYS, all_queries

FOLDER = "/root/testdata/sf0.001"
CHECKED = (
    "driver_trends constructor_over_seasons pit_stop_effectiveness constructor_streaks"
    " driver_wins_in_year star_driver star_results flatten_results flatten_pit_stops merge_driver"
    " merge_laps merge_results merge_constructor_upsert stream_merge_all stream_merge_laps check_fk"
    " driver_streaks most_wins_in_row_true profile_mismatch star_all_counts scan_csv_clean"
    " coerce_numeric null_tokens scan_csv_rejects scan_json_docs scan_requests"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def base():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_statement(spark, base, name):
    frame = queries()[name](spark, FOLDER)
    reply = base.sql(oracle_sql()[name])
    kinds = dict(zip(reply.columns, map(str, reply.types), strict=True))
    assert {f.name: SAME[f.dataType.simpleString()] for f in frame.schema} == kinds
    options = {"date_as_object": True, "integer_object_nulls": True}
    result = frame.toArrow().to_pandas(**options)
    assert compare(result, reply.to_arrow_table().to_pandas(**options)) == ""


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_every_statement_has_its_query():
    assert set(oracle_sql()) <= set(queries())
    assert set(all_queries()) <= set(oracle_sql())
    assert set(STAR_KEYS.values()) == set(STAR)
