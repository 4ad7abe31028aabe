from collections import ChainMap
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from gridstats.operators.runs import longest_runs
from gridstats.plans import views

PLACES = [1, 1, 2, 4, 1, 3, 1, 1, 1]


@pytest.fixture(scope="module")
def star(table):
    """Driver 1 has a known history, 2 podiums only, 3 neither, 4 and 5 share names, 6 has none."""
    days = [date(2023, 1, 1) + timedelta(days=7 * i) for i in range(len(PLACES))]
    races = [
        {"raceId": i + 1, "circuitId": 1 + i % 2, "date": d, "year": d.year, "round": i + 1}
        for i, d in enumerate(days)
    ]
    results = []

    def result(race, driver, place, team=1, **extra):
        n = len(results) + 1
        results.append(
            {
                "resultId": n,
                "raceId": race,
                "driverId": driver,
                "constructorId": team,
                "driverStandingsId": n,
                "constructorStandingsId": n,
                "positionOrder": place,
                "points": 1.5,
                **extra,
            }
        )

    for i, place in enumerate(PLACES):
        result(i + 1, 1, place, fastestLapTime=f"1:3{i}.0" if i else None)
    result(1, 2, 2, team=2)
    result(1, 2, 9, team=2)
    result(2, 3, 9, team=2)
    result(3, 4, 1, team=2)
    result(4, 5, 1, team=2)
    result(5, 6, 1, team=2)
    names = [(1, "ann"), (2, "bob"), (3, "cy"), (4, "dee"), (5, "dee"), (6, None)]
    return {
        "driverDim": table(
            "driverDim",
            *[{"driverId": i, "driverRef": r, "forename": "f", "surname": "s"} for i, r in names],
        ),
        "constructorDim": table(
            "constructorDim",
            {"constructorId": 1, "constructorRef": "red", "name": "Red"},
            {"constructorId": 2, "constructorRef": "blue", "name": "Blue"},
        ),
        "circuitDim": table(
            "circuitDim",
            {"circuitId": 1, "name_y": "North", "country": "N"},
            {"circuitId": 2, "name_y": "South", "country": "S"},
        ),
        "raceDim": table("raceDim", *races),
        "raceResultsFact": table("raceResultsFact", *results),
        "driverStandingsDim": table(
            "driverStandingsDim",
            *[
                {
                    "driverStandingsId": r["resultId"],
                    "driverId": r["driverId"],
                    "wins": None if r["driverId"] == 2 and r["positionOrder"] == 9 else 3,
                }
                for r in results
            ],
        ),
        "constructorStandingsDim": table(
            "constructorStandingsDim",
            *[
                {
                    "constructorStandingsId": r["resultId"],
                    "constructorId": r["constructorId"],
                    "wins_constructorstandings": r["resultId"],
                }
                for r in results
            ],
        ),
        "pitStopsDim": table(
            "pitStopsDim",
            {"raceId": 1, "driverId": 1, "stop": 1, "duration": 20.0},
            {"raceId": 1, "driverId": 1, "stop": 2, "duration": 30.0},
            {"raceId": 2, "driverId": 1, "stop": 1, "duration": None},
            {"raceId": 1, "driverId": 3, "stop": 1, "duration": 9.0},
        ),
        "qualificationsDim": table(
            "qualificationsDim",
            {"driverId": 1, "quali_time": None},
            {"driverId": 1, "quali_time": "00:00:00"},
            {"driverId": 1, "quali_time": "01:00:00"},
        ),
    }


def rows(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


def test_driver_streaks(star):
    found = rows(
        views.driver_streaks(star),
        "driver_reference",
        "longest_podium_streak",
        "longest_winning_streak",
    )
    # an unnamed driver's winning runs match nothing; "dee" counts both ids' results as one history
    assert found == [("ann", 5, 3), ("dee", 2, 2), ("bob", 1, 0), (None, 1, 0)]


def test_team_streaks_follow_date_then_result(star):
    found = rows(
        views.constructor_streaks(star), "constructor_reference", "longest_podium_streak"
    )
    assert found == [("red", 5), ("blue", 3)]


def test_wins_in_a_row_modes(star):
    assert rows(views.most_wins_in_row(star), "driver_reference", "wins_in_a_row") == [("ann", 6)]
    strict = views.most_wins_in_row(star, mode="consecutive")
    assert rows(strict, "driver_reference", "wins_in_a_row") == [("ann", 3)]


def test_best_and_worst_labels_are_swapped(star):
    found = views.driver_by_circuit(star).where("driver_reference = 'bob'")
    assert rows(found, "best_finish_position", "worst_finish_position") == [(9, 2)]


def test_null_wins_rank_first(star):
    found = views.driver_wins_in_year(star, 2023, "wins_in_2023")
    assert rows(found, "driver_reference", "wins_in_2023")[0] == ("bob", None)
    assert views.driver_wins_in_year(star, 2022).count() == 0


def test_shared_names_give_one_row(star):
    found = views.driver_trends(star).where("driver_reference = 'dee'")
    assert rows(found, "races_count", "wins", "total_points") == [(2, 2, 3.0)]


def test_career_with_and_without(star):
    everyone = {r for (r,) in rows(views.career_excluding(star, "ann"), "driver_reference")}
    assert everyone == {"bob", "cy", "dee"}
    assert rows(views.career_only(star, "ann"), "wins_count") == [(6,)]


def test_races_entered_counts_races_once(star):
    found = views.constructor_over_seasons(star).where("constructor_reference = 'blue'")
    assert rows(found, "races_count", "races_entered") == [(6, 5)]


def test_pit_stops_fan_out(star):
    found = views.pit_stop_effectiveness(star)
    assert rows(found, "driver_reference", "pit_stops_count", "avg_pit_stop_duration") == [
        ("ann", 3, 25.0)
    ]


def test_qualifying(star):
    found = views.driver_qualifying(star)
    assert rows(found, "avg_qualifying_seconds", "pole_positions") == [(1800.0, 1)]


def test_circuit_records(star):
    assert views.circuit_records(star).count() == len(PLACES) - 1
    best = views.circuit_records(star, mode="record")
    assert rows(best, "circuit_name", "fastest_lap_time") == [
        ("North", "1:32.0"),
        ("South", "1:31.0"),
    ]


def test_season_record_tie_goes_to_the_lower_reference(star):
    others = views.most_wins_season_excluding(star, "ann")
    assert rows(others, "driver_reference", "wins_count") == [("dee", 2)]


def test_all_views_are_installed(spark, star):
    names = views.register_views(spark, star)
    assert len(names) == 23
    assert all(spark.table(n).columns for n in names)
    assert "wins_in_2023" in spark.table("DriverWins2023View").columns
    assert dict(spark.table("DriverQualificationPerformanceView").dtypes)[
        "avg_qualifying_time"
    ].startswith("interval")


def brute_force(marks):
    best = run = 0
    for mark in marks:
        run = run + 1 if mark else 0
        best = max(best, run)
    return best


@pytest.mark.parametrize("parts", [1, 3, 16])
def test_runs_do_not_depend_on_where_a_history_is_cut(spark, parts):
    """One history holds most rows, so that it spans many stretches."""
    data = [
        (1 if n % 5 else n % 40, n, (n * n + n // 7) % 11 > 2, n % 97 > 40) for n in range(4000)
    ]
    df = spark.createDataFrame(data, "h long, n long, a boolean, b boolean").repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        flags = {"a_run": F.col("a"), "b_run": F.col("b")}
        found = longest_runs(df, "h", "h", ["n"], flags).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    histories = {}
    for h, _, a, b in data:
        histories.setdefault(h, []).append((a, b))
    expected = {
        h: (brute_force(a for a, _ in m), brute_force(b for _, b in m))
        for h, m in histories.items()
    }
    assert {r.h: (r.a_run, r.b_run) for r in found} == expected


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_on_the_jvm_and_reduce_before_the_shuffle(star):
    for name, view in views.view_plans(ordered=False).items():
        plan = plan_of(view(ChainMap(star)))
        assert "Python" not in plan, name
        assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan, name
        if "Wins20" in name:
            assert "WindowGroupLimit" in plan
        elif "Most" not in name:
            assert "SinglePartition" not in plan, name
