"""Long histories cut into stretches, and the exchange that the star tables share."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from gridstats.operators.runs import add_stretches, longest_runs
from gridstats.plans.star import SHARED_KEY, split_all
from gridstats.schemas import wide_types
from gridstats.session import scratch_dir, stage_by


def longest_by_hand(rows):
    """history -> rows in order -> per member its most rows in one run of wins."""
    best = {}
    for history in {r[0] for r in rows}:
        run = {}
        for _, member, day, number, won in sorted(
            (r for r in rows if r[0] == history), key=lambda r: (r[2] is not None, r[2] or date.min, r[3])
        ):
            best.setdefault(member, 0)
            if won:
                run[member] = run.get(member, 0) + 1
                best[member] = max(best[member], run[member])
            else:
                run = {}
    return best


@pytest.mark.parametrize("budget", [1, 7, 40, 10_000])
def test_stretches_of_any_size_give_the_same_runs(spark, budget):
    rnd = random.Random(budget)
    rows, number = [], 0
    for history in range(6):
        for _ in range(rnd.choice([3, 30, 90])):
            number += 1
            day = date(2020, 1, 1) + timedelta(days=rnd.choice([rnd.randint(0, 1500), rnd.randint(0, 9)]))
            member = history * 10 + rnd.choice([0, 0, 1])
            rows.append((history, member, rnd.choice([day] * 9 + [None]), number, rnd.choice([True, True, True, False, None])))
    frame = spark.createDataFrame(rows, "history int, member int, date date, id int, won boolean")
    cut = add_stretches(frame, "history", "date", budget)
    assert cut.count() == len(rows)
    found = longest_runs(cut, "history", "member", ["date", "id"], {"best": F.col("won")}, F.col("_part"))
    assert {r.member: r.best for r in found.collect()} == longest_by_hand(rows)
    sizes = {r["history"]: r["n"] for r in cut.groupBy("history").agg(F.count_distinct("_part").alias("n")).collect()}
    counts = {h: sum(r[0] == h for r in rows) for h in sizes}
    assert all((n == 1) == (counts[h] <= budget) or counts[h] > budget for h, n in sizes.items())


def test_race_and_driver_tables_dedupe_without_a_shuffle(spark):
    values = {c: "CAST(id % 9 AS STRING)" for c in wide_types()}
    wide = spark.range(60).selectExpr(
        *[f"CAST({v} AS {wide_types()[c].simpleString()}) AS `{c}`" if wide_types()[c].simpleString() != "date"
          else f"DATE '2024-01-01' AS `{c}`" for c, v in values.items()]
    )
    tables = split_all(wide)
    both = [t for t, rows in tables.items() if set(SHARED_KEY) <= set(rows.columns)]
    assert sorted(both) == ["lapsDim", "pitStopsDim", "qualificationsDim", "raceResultsFact", "sprintDim"]
    for table in both:
        plan = tables[table]._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and tables[table].count() == 9
    assert "Exchange" in tables["driverDim"]._jdf.queryExecution().executedPlan().toString()


def test_staged_buckets_leave_nothing_in_the_catalog(spark):
    rows = spark.range(50).withColumn("k", F.col("id") % 7)
    staged = stage_by(rows, "buckets", ["k"])
    assert staged.groupBy("k").count().count() == 7 and staged.count() == 50
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("staged_")]
    assert all(scratch_dir(spark).removeprefix("file:") in f for f in staged.inputFiles())
