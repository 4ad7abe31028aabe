"""The wide file's many columns: made once an order, compiled apart, cleaned in one projection."""

import pytest

from gridstats.functions.parsing import NULL_TOKENS, to_day, to_number, to_whole
from gridstats.session import scratch_path
from gridstats.sources import csv
from gridstats.testbed.roles import Roles


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_columns_stay_out_of_whole_stage_code(spark):
    path = scratch_path(spark, "wide")
    csv.write_csv(Roles(spark, "/root/testdata/sf0.001").wide_text().limit(50), path)
    rows = csv.read_wide_csv(spark, path)
    for df, projections in ((rows, 1), (csv.clean_wide(rows), 1), (csv.replace_null_tokens(rows), 2)):
        plan = plan_of(df)
        assert "*(" not in plan  # a step in whole-stage code
        assert plan.count("Project [") <= projections


@pytest.mark.parametrize("reader", [to_number, to_whole, to_day, lambda c: to_whole(c, "int")])
def test_no_reader_takes_a_token_for_a_value(spark, reader):
    tokens = spark.createDataFrame([(t,) for t in NULL_TOKENS], "c string")
    assert {r[0] for r in tokens.selectExpr(reader("c")).collect()} == {None}


def test_texts_of_an_order_are_made_before_its_lines_are_joined(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = Roles(spark, "/root/testdata/sf0.001").wide_text()
        lines = plan_of(wide).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joined = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    made = next(i for i, line in enumerate(lines) if "Project" in line and "struct(" in line)
    assert joined < made
    assert not any("concat(surname" in line for line in lines[:joined])


def test_fields_of_uneven_lines_are_counted_without_making_them(spark):
    path = scratch_path(spark, "uneven")
    lines = ["a,b,c", "1,2,3,4", '"x,y",2,3,4', '1,"say ""a,b"", c",3,4,5', "1,2", '1,2,3,"",', 'u"v,w"x,2,3', "é,,,,,"]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    rejects = csv.wide_csv_rejects(spark, path)
    assert sorted((r.line, r.fields) for r in rejects.collect()) == sorted(
        [(lines[1], 4), (lines[2], 4), (lines[3], 5), (lines[5], 5), (lines[6], 4), (lines[7], 6)]
    )
    assert "regexp_extract_all" not in plan_of(rejects)  # a text for every comma
