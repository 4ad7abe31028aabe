from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstats.functions.parsing import null_if_token, to_day, to_number, to_whole
from gridstats.functions.times import lap_millis, millis_interval, pit_seconds, seconds_of_day
from gridstats.session import scratch_path
from gridstats.sources import csv
from gridstats.sources.requests import RequestReader, read_requests


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "c string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text", ["", "NA", "NaN", "null", "\\N", "#N/A", "None", None])
def test_missing_value_tokens_become_null(spark, text):
    assert one(spark, text, F.expr(null_if_token("c"))) is None


def test_other_text_is_kept(spark):
    assert one(spark, "Nashville", F.expr(null_if_token("c"))) == "Nashville"


@pytest.mark.parametrize(
    "text, value",
    [
        ("1", 1.0),
        (" -2.5 ", -2.5),
        ("1e3", 1000.0),
        (".5", 0.5),
        ("inf", float("inf")),
        ("abc", None),
        ("1d", None),
        ("2.f", None),
        ("0x1p3", None),
        ("NaN", None),
        ("1:02.3", None),
        (None, None),
    ],
)
def test_numbers_as_pandas_reads_them(spark, text, value):
    assert one(spark, text, F.expr(to_number("c"))) == value


@pytest.mark.parametrize(
    "text, value",
    [("7", 7), ("3.0", 3), ("3.5", None), ("9007199254740993", 9007199254740993), ("x", None)],
)
def test_whole_numbers(spark, text, value):
    assert one(spark, text, F.expr(to_whole("c"))) == value


def test_days(spark):
    assert str(one(spark, "2024-02-29", F.expr(to_day("c")))) == "2024-02-29"
    assert one(spark, "2024-02-30", F.expr(to_day("c"))) is None


@pytest.mark.parametrize(
    "text, mode, millis",
    [
        ("1:32.300", "reference", 92299),
        ("1:32.300", "lenient", 92300),
        ("1:02:03.4", "reference", None),
        ("32.3", "reference", None),
    ],
)
def test_lap_millis(spark, text, mode, millis):
    assert one(spark, text, lap_millis(F.col("c"), mode)) == millis


def test_pit_seconds(spark):
    assert one(spark, "1:02.300", pit_seconds(F.col("c"))) == pytest.approx(62.3)
    assert one(spark, "23.275", pit_seconds(F.col("c"))) is None
    assert one(spark, "23.275", pit_seconds(F.col("c"), "lenient")) == 23.275


def test_times_of_day_and_intervals(spark):
    assert one(spark, "17:28:30", seconds_of_day(F.col("c"))) == 62910
    assert one(spark, "13:00:00Z", seconds_of_day(F.col("c"))) == 46800
    millis = F.col("c").cast("double")
    assert one(spark, "92299", millis_interval(millis)) == timedelta(milliseconds=92299)


def test_wide_file_round_trip(spark):
    path = scratch_path(spark, "csv")
    names = ["_ord", "driverId", "surname", "alt", "dob", "positionText"]
    rows = [
        ("0", "1", 'O"Neil, J', "1d", "1990-01-02", "R"),
        ("1", "\\N", "NaN", "12.5", "\\N", "1"),
        ("2", "3.0", "", "abc", "bad", "2"),
    ]
    text = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    csv.write_csv(text, path)
    cleaned = csv.clean_wide(csv.read_wide_csv(spark, path, text.schema)).orderBy("_ord")
    assert cleaned.columns == names[:-1]
    found = [(r._ord, r.driverId, r.surname, r.alt, str(r.dob)) for r in cleaned.collect()]
    assert found == [
        (0, 1, 'O"Neil, J', None, "1990-01-02"),
        (1, None, None, 12.5, "None"),
        (2, 3, None, None, "None"),
    ]


def test_wide_columns_are_found_by_name(spark):
    path = scratch_path(spark, "csv")
    wanted = T.StructType([T.StructField(c, T.StringType()) for c in ("_ord", "forename", "surname")])
    swapped = spark.createDataFrame([("Max", "x", "One", "7")], "surname string, extra string, forename string, _ord string")
    csv.write_csv(swapped, path)
    assert [tuple(r) for r in csv.read_wide_csv(spark, path, wanted).collect()] == [("7", "One", "Max")]
    with pytest.raises(ValueError, match="no column dob"):
        csv.read_wide_csv(spark, path, T.StructType([*wanted, T.StructField("dob", T.StringType())]))
    nameless = scratch_path(spark, "csv")
    spark.createDataFrame([(",forename,surname",), ("3,One,Max",)], "value string").coalesce(1).write.text(nameless)
    assert [tuple(r) for r in csv.read_wide_csv(spark, nameless, wanted).collect()] == [("3", "One", "Max")]


def test_uneven_lines_are_told_apart(spark):
    wanted = T.StructType([T.StructField(c, T.StringType()) for c in ("_ord", "surname", "code")])
    path = scratch_path(spark, "csv")
    lines = [
        "_ord,surname,code",
        '1,"One, ""Two""",x',
        '2,"One, Two",x,y',
        "3,Max",
        '4,5" disk,\\N,',
        '5,"a,b","c,d"',
        "6,Max,,,",
        "7,,",
    ]
    spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1).write.text(path)
    rows = {tuple(r) for r in csv.read_wide_csv(spark, path, wanted).collect()}
    assert rows == {
        ("1", 'One, "Two"', "x"),
        ("3", "Max", None),
        ("5", "a,b", "c,d"),
        ("7", None, None),
    }
    rejects = {tuple(r) for r in csv.wide_csv_rejects(spark, path).collect()}
    assert rejects == {("2", 4, lines[2]), ("4", 4, lines[4]), ("6", 5, lines[6])}
    assert csv.read_wide_csv(spark, path, wanted).count() == 4
    with pytest.raises(Exception, match="more than 3 fields"):
        csv.read_wide_csv(spark, path, wanted, strict=True).collect()


def test_quoted_line_breaks(spark):
    wanted = T.StructType([T.StructField(c, T.StringType()) for c in ("_ord", "surname")])
    path = scratch_path(spark, "csv")
    data = spark.createDataFrame([("1", "a\nb"), ("2", 'c,"\nd"')], wanted)
    csv.write_csv(data, path)
    assert {tuple(r) for r in csv.read_wide_csv(spark, path, wanted, multi_line=True).collect()} == {
        ("1", "a\nb"),
        ("2", 'c,"\nd"'),
    }
    assert csv.wide_csv_rejects(spark, path, multi_line=True).count() == 0


def test_requests_are_dealt_to_tasks(spark):
    def fetch(season, number):
        return [f"{season}/{number}/{page}" for page in range(number % 3)]

    asked = read_requests(spark, fetch, [2023, 2024], 1, 5, rounds_per_task=2)
    assert asked.rdd.getNumPartitions() == 6
    found = {(r.value, *r._seq) for r in asked.collect()}
    wanted = {(s, n, p) for s in (2023, 2024) for n in range(1, 6) for p in range(n % 3)}
    assert found == {(f"{s}/{n}/{p}", s, n, p) for s, n, p in wanted}
    assert read_requests(spark, fetch, [], 1, 5).count() == 0
    with pytest.raises(ValueError, match="at least 1"):
        read_requests(spark, fetch, [2023], 1, 5, attempts=0)


def test_a_failed_request_is_made_again_whole():
    calls = []

    def fetch(season, number):
        calls.append(number)
        yield "first"
        if len(calls) < 3:
            raise ConnectionError("no answer")

    assert RequestReader(fetch, [], 3, 0.0)._documents(2024, 1) == ["first"]
    assert len(calls) == 3
    calls.clear()
    with pytest.raises(ConnectionError):
        RequestReader(fetch, [], 2, 0.0)._documents(2024, 1)
