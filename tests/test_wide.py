"""The wide file at scale: what its joins shuffle, and how it is landed."""

import os
import re

from gridstats.operators.merge import MergeSpec, merge_new
from gridstats.sources import csv
from gridstats.testbed.roles import LINES_PER_TASK, Roles


def test_wide_rows_are_shuffled_by_order_and_customer_only(spark):
    wide = Roles(spark, "/root/testdata/sf0.1").wide_text()
    plan = wide._jdf.queryExecution().executedPlan().toString()
    keys = set(re.findall(r"hashpartitioning\((\w+)#", plan))
    assert keys <= {"l_orderkey", "o_orderkey", "o_custkey", "c_custkey"}
    # the texts are made behind the last shuffle
    shuffled = [line for line in plan.splitlines() if "hashpartitioning(l_orderkey" in line]
    assert shuffled and "surname" not in plan[plan.index(shuffled[0]) :]


def test_teams_of_orders_are_those_that_orders_name(spark):
    roles = Roles(spark, "/root/testdata/sf0.001")
    named = {r[0] for r in roles["raceResultsFact"].select("constructorId").distinct().collect()}
    known = {r[0] for r in roles["constructorDim"].select("constructorId").collect()}
    teams = [r[0] for r in roles.teams_of_orders().select("constructorId").collect()]
    assert sorted(teams) == sorted(named & known)
    assert LINES_PER_TASK > 0


def test_wide_csv_is_landed_compressed_and_read_back(spark, tmp_path):
    wide = Roles(spark, "/root/testdata/sf0.001").wide_text()
    path = str(tmp_path / "wide")
    csv.write_csv(wide, path, compression="gzip")
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert parts and all(f.endswith(".csv.gz") for f in parts)
    assert csv.read_wide_csv(spark, path).count() == wide.count()


def test_a_merge_shuffles_incoming_rows_by_key_once(spark):
    spec = MergeSpec("lapsDim", ("raceId", "lap"), ("_seq",), key=("raceId", "lap"))
    rows = [(1, 1, 0), (1, 1, 1), (1, 2, 2), (2, 1, 3), (None, 1, 4), (None, 1, 5)]
    incoming = spark.createDataFrame(rows, "raceId long, lap int, _seq int")
    target = spark.createDataFrame([(1, 2)], "raceId long, lap int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_new(incoming, target, spec)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        assert sorted(map(str, map(tuple, merged.collect()))) == sorted(
            ["(1, 1)", "(2, 1)", "(None, 1)", "(None, 1)"]
        )
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
