import pytest
from pyspark.sql import functions as F

from gridstats.operators import profile
from gridstats.operators.checks import key_report, key_violations, orphan_report, orphans
from gridstats.operators.dedupe import distinct_project, first_per_key
from gridstats.plans.star import load_star, split_table
from gridstats.schemas import ORDER_COLUMN, wide_types
from gridstats.session import scratch_path
from gridstats.sources.csv import clean_wide
from gridstats.sources.tables import StarTables


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(1, 5, 5.0, "x"), (2, None, None, "x"), (2, None, None, "x"), (None, 7, 8.0, "y")]
    return spark.createDataFrame(rows, "k long, a long, b double, c string")


def test_profile(frame):
    assert profile.shape(frame).first() == (4, 4)
    assert profile.column_types(frame)[0] == ("k", "bigint")
    assert profile.min_max(frame, "a").first() == (5, 7)
    assert profile.has_duplicate_key(frame, "k").first()[0] is True
    assert profile.duplicate_row_count(frame).first()[0] == 1
    assert profile.any_nulls(frame).first() == (True, True, True, False)
    assert [tuple(r) for r in profile.top_values(frame, "c").collect()] == [("x", 3), ("y", 1)]
    assert profile.top_values(frame, "c", 1).count() == 1
    assert {r.k for r in profile.distinct_values(frame, "k").collect()} == {1, 2, None}


def test_mismatch_is_reported_only_where_the_other_column_is_complete(frame):
    assert profile.mismatch_mask(frame, ["k"], "a", "b").where("is_mismatch").count() == 0
    assert profile.mismatch_mask(frame, ["k"], "k", "c").where("is_mismatch").count() == 4


def test_equal_columns_also_agree_in_type(frame):
    same = frame.withColumn("d", F.col("a"))
    assert profile.columns_equal(same, "a", "d").first()[0] is True
    assert profile.columns_equal(frame, "a", "b").first()[0] is False
    assert profile.columns_equal(same, "a", "k").first()[0] is False


def test_sample_is_repeatable(spark):
    df = spark.range(1000)
    first = [r.id for r in profile.sample_rows(df, ["id"], 10, seed=1).collect()]
    again = profile.sample_rows(df.repartition(7), ["id"], 10, seed=1, columns=["id"])
    assert first == [r.id for r in again.collect()] and len(set(first)) == 10
    assert first != [r.id for r in profile.sample_rows(df, ["id"], 10, seed=2).collect()]


def test_keys_and_references(spark, frame):
    assert key_report(frame, "t", "k").first() == ("t", 1, 1)
    assert {(r.k, r.row_count) for r in key_violations(frame, "k").collect()} == {(2, 2), (None, 1)}
    tables = {"child": frame, "parent": spark.createDataFrame([(1,), (None,)], "id long")}
    assert [tuple(r) for r in orphans(tables, "child", "k", "parent", "id").collect()] == [(2, 2)]
    report = orphan_report(tables, "child", "k", "parent", "id").first()
    assert (report.orphan_rows, report.orphan_values) == (2, 1)


def test_first_per_key_and_distinct(frame):
    ordered = frame.withColumn("n", F.monotonically_increasing_id())
    assert first_per_key(ordered, ["k"], ["n"]).count() == 3
    assert first_per_key(ordered, ["a"], ["n"], null_keys_match=False).count() == 4
    assert distinct_project(frame, ["k", "a"]).count() == 3


def test_star_split_keeps_the_first_name_of_an_id_and_all_drifting_teams(spark):
    columns = [c for c in wide_types()]

    def row(order, **values):
        given = {ORDER_COLUMN: order, "driverId": "1", "constructorId": "4", "raceId": "9", **values}
        return tuple(str(given[c]) if c in given else "\\N" for c in columns)

    text = spark.createDataFrame(
        [
            row(10, surname="Late", name="Red"),
            row(2, surname="Early", name="Red"),
            row(3, surname="Late", name="Red Ltd"),
            row(3, surname="Late", name="Red Ltd"),
        ],
        ", ".join(f"`{c}` string" for c in columns),
    )
    wide = clean_wide(text)
    assert [r.surname for r in split_table(wide, "driverDim").collect()] == ["Early"]
    assert split_table(wide, "constructorDim").count() == 2
    assert split_table(wide, "sprintDim").count() == 1
    tables = StarTables(spark, scratch_path(spark, "star"))
    loaded = []
    load_star(wide, tables, lambda table, batch: loaded.append(table))
    assert loaded.index("raceDim") < loaded.index("raceResultsFact") and len(loaded) == 13
    # ids are unique after the load, whatever drifted in the file
    assert tables["constructorDim"].count() == 1 and tables["driverDim"].count() == 1
    load_star(wide, tables)
    assert tables["driverDim"].count() == 1


def test_star_load_keeps_the_first_of_the_file_and_can_be_repeated(spark):
    columns = list(wide_types())

    def row(ord_, name, lap):
        values = {ORDER_COLUMN: str(ord_), "constructorId": "4", "name": name, "raceId": "1", "lap": lap, "driverId": "1"}
        return tuple(values.get(c) for c in columns)

    rows = [row(9, "Alpha", "2"), row(1, "Zeta", "1"), row(3, "Zeta", "1")]
    wide = clean_wide(spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns)))
    tables = StarTables(spark, scratch_path(spark, "star"))
    for _ in range(2):
        load_star(wide, tables, batch=0)
        assert [r.name for r in tables["constructorDim"].collect()] == ["Zeta"]
        assert tables["lapsDim"].count() == 2
        kept = spark.read.parquet(tables.place("_rejects/constructorDim", 0)).collect()
        assert [(r.name, r._reason) for r in kept] == [("Alpha", "repeated_id")]
