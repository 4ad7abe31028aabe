import json

import pytest
from pyspark.sql import functions as F

from gridstats.operators.ids import allocate_ids
from gridstats.operators.merge import merge_audit, upsert_by_key
from gridstats.plans import flatten
from gridstats.plans.loads import (
    LOADS,
    as_records,
    audit_of,
    merge_all,
    merge_batch,
    results_load,
    retry_rejects,
)
from gridstats.session import scratch_path
from gridstats.sources import documents
from gridstats.sources.tables import StarTables
from gridstats.sources.topics import stream_folder
from gridstats.streaming.merge_stream import merge_stream


def docs(spark, *values):
    rows = [(v if isinstance(v, str) else json.dumps(v), n) for n, v in enumerate(values)]
    return spark.createDataFrame(rows, "value string, _seq long")


def drivers(*refs):
    items = [{"driverId": r, "familyName": f"S{n}"} if r else {"familyName": f"S{n}"} for n, r in enumerate(refs)]
    return {"MRData": {"DriverTable": {"Drivers": items}}}


def races(*items):
    return {"MRData": {"RaceTable": {"Races": list(items)}}}


def race(day, **more):
    return {"season": "2024", "round": day[-2:].lstrip("0"), "date": day, "raceName": "R", "url": "u",
            "Circuit": {"circuitId": "monza"}, **more}


@pytest.fixture
def star(table):
    tables = {
        "driverDim": table("driverDim", {"driverId": 7, "driverRef": "old"}, {"driverId": 3, "driverRef": "two"}),
        "circuitDim": table("circuitDim", {"circuitId": 5, "circuitRef": "monza"}),
        "constructorDim": table("constructorDim", {"constructorId": 1, "constructorRef": "red"}),
        "raceStatusDim": table("raceStatusDim", {"statusId": 1, "status": "Finished"}),
        "raceDim": table("raceDim", {"raceId": 10, "date": None}),
        "constructorStandingsDim": table(
            "constructorStandingsDim",
            {"constructorStandingsId": 4, "constructorId": 1},
            {"constructorStandingsId": 9, "constructorId": 1},
        ),
        "driverStandingsDim": table("driverStandingsDim", {"driverStandingsId": 6, "driverId": 7}),
    }
    for name in ("freePracticeDim", "lapsDim", "pitStopsDim", "raceResultsFact"):
        tables[name] = table(name)
    return tables


def test_new_drivers_get_the_next_ids_in_arrival_order(spark, star):
    incoming = docs(spark, drivers("b", "old", None, None, "a"), drivers("a", "c", None))
    found = LOADS["driverDim"].new_rows(incoming, star).orderBy("driverId").collect()
    # the first unnamed driver of each document is always new
    assert [(r.driverId, r.driverRef) for r in found] == [(8, "b"), (9, None), (10, "a"), (11, "c"), (12, None)]


def test_merging_twice_adds_nothing(spark, star):
    incoming = docs(spark, drivers("b", "old", "a"))
    load = LOADS["driverDim"]
    first = load.new_rows(incoming, star)
    again = load.new_rows(incoming, {**star, "driverDim": star["driverDim"].unionByName(first)})
    assert first.count() == 2 and again.count() == 0


def test_circuits_without_a_place_are_dropped(spark, star):
    where = {"locality": "Spa", "country": "Belgium", "lat": "50.4", "long": ""}
    items = [
        {"circuitId": "spa", "circuitName": "Spa", "url": "u", "Location": where},
        {"circuitId": "x", "circuitName": "X", "url": "u", "Location": {"locality": "", "country": "Y"}},
        {"circuitId": "z", "circuitName": "Z", "url": "u"},
    ]
    incoming = docs(spark, {"MRData": {"CircuitTable": {"Circuits": items}}})
    rows = LOADS["circuitDim"].new_rows(incoming, star).collect()
    assert [(r.circuitId, r.circuitRef, r.lat, r.lng, r.alt) for r in rows] == [(6, "spa", 50.4, None, None)]
    assert LOADS["circuitDim"].rejects(incoming, star).count() == 2


def test_first_race_document_of_a_date_wins_also_for_practice(spark, star):
    session = {"FirstPractice": {"date": "2024-03-01", "time": "10:00:00Z"}}
    incoming = docs(spark, races(race("2024-03-03")), races(race("2024-03-03", time="15:00:00Z", **session)))
    new = LOADS["raceDim"].new_rows(incoming, star)
    assert [(r.raceId, r.circuitId, r.year, r.round, r.time_races) for r in new.collect()] == [(11, 5, 2024, 3, None)]
    star = {**star, "raceDim": new}
    assert [r.fp1_date for r in LOADS["freePracticeDim"].new_rows(incoming, star).collect()] == [None]
    kept = LOADS["freePracticeDim"].new_rows(incoming, star, "lenient").collect()
    assert [str(r.fp1_date) for r in kept] == ["2024-03-01"]


def lap_race(*timings, day="2024-03-03"):
    laps = [{"number": n, "Timings": [{"driverId": d, "position": "1", "time": t}]} for d, n, t in timings]
    return races({"date": day, "Laps": laps})


def test_laps(spark, star, table):
    from datetime import date

    star = {**star, "raceDim": table("raceDim", {"raceId": 11, "date": date(2024, 3, 3)})}
    incoming = docs(
        spark,
        lap_race(("old", "1", "1:32.300"), ("old", "1", "1:40.000"), ("who", "1", "1:30.0"), ("old", "2", "1:02:03.4")),
        lap_race(("old", "1", "1:30.0"), day="2020-01-01"),
    )
    load = LOADS["lapsDim"]
    found = load.new_rows(incoming, star).collect()
    assert [(r.raceId, r.driverId, r.lap, r.milliseconds_laptimes) for r in found] == [(11, 7, 1, 92299.0)]
    reasons = sorted(r._reason for r in load.rejects(incoming, star).collect())
    assert reasons == ["bad_time", "missing_driver", "missing_race"]
    counts = {r.outcome: r.row_count for r in load.audit(incoming, star).collect()}
    assert counts == {"bad_time": 1, "missing_driver": 1, "missing_race": 1, "inserted": 1, "repeated": 1}


def result_record(**changes):
    record = {"round": "3", "date": "2024-03-03", "constructorId": "red", "driverId": "old", "statusId": "Finished",
              "positionOrder": "1", "points": 25.0, "laps": 50, "grid": 2, "fastestLapTime": None,
              "fastestLapSpeed": None, "time": None, "fastestLap": None}
    return {k: v for k, v in {**record, **changes}.items() if v != "absent"}


def test_results_from_a_topic(spark, star, table):
    from datetime import date

    star = {**star, "raceDim": table("raceDim", {"raceId": 11, "date": date(2024, 3, 3), "round": 3})}
    text = docs(
        spark,
        result_record(),
        result_record(),
        result_record(round="absent"),
        result_record(statusId="Lost"),
        result_record(constructorId="?"),
        result_record(driverId="two"),
        result_record(date="2024-03-04"),
    )
    records = documents.parse_records(text, "result", ["round"])
    load = results_load(order=0)
    found = load.new_rows(records, star).orderBy("resultId").collect()
    assert [(r.resultId, r.raceId, r.driverId, r.constructorStandingsId, r.driverStandingsId) for r in found] == [
        (1, 11, 7, 4, 6),
        (2, 11, 7, 4, 6),
    ]
    assert sorted(r._reason for r in load.rejects(records, star).collect()) == [
        "missing_constructor", "missing_driver_standings", "missing_keys", "missing_race", "missing_status",
    ]
    assert results_load("max", order=0).new_rows(records, star).first().constructorStandingsId == 9
    once = results_load(order=0, key=("raceId", "driverId")).new_rows(records, star)
    assert once.count() == 1


def test_pit_record_keys_may_be_null_but_not_absent(spark):
    whole = {"season": "2024", "round": "3", "driverId": "old", "stop": 1, "lap_pitstops": 9, "time_pitstops": "t", "duration": None}
    short = {k: v for k, v in whole.items() if k != "duration"}
    parsed = documents.parse_records(docs(spark, whole, short), "pit_stop", list(whole))
    assert [r._reason for r in parsed.orderBy("_seq").collect()] == [None, "missing_keys"]


def test_flatten_skips_what_is_missing(spark):
    assert flatten.flatten_results(docs(spark, {}, races(), races({"round": "1"}), "no json")).count() == 0
    standings = {"MRData": {"StandingsTable": {"StandingsLists": []}}}
    assert flatten.flatten_driver_standings(docs(spark, standings)).count() == 0
    result = {"position": "2", "points": "18", "Driver": {"driverId": "a"}, "FastestLap": {"lap": "7"}}
    row = flatten.flatten_results(docs(spark, races({"round": "1", "Results": [result]}))).first()
    assert (row.fastestLap, row.fastestLapSpeed, row.fastestLapTime, row.time) == (7, None, None, None)
    checked = documents.validate_documents(docs(spark, races(), {}), "MRData.RaceTable.Races")
    assert [r._reason for r in checked.orderBy("_seq").collect()] == [None, "missing_path"]
    with pytest.raises(Exception, match="no MRData.RaceTable.Races"):
        documents.validate_documents(docs(spark, {}), "MRData.RaceTable.Races", strict=True).collect()


def test_documents_one_per_file_and_requests(spark):
    path = scratch_path(spark, "docs")
    pretty = json.dumps(drivers("a", "b"), indent=2)
    spark.createDataFrame([(pretty,)], "value string").write.text(path)
    whole = documents.read_documents(spark, path, one_per_file=True)
    assert flatten.document_counts(whole, "drivers").first().item_count == 2
    assert documents.request_list(spark, [2023, 2024], 1, 21).count() == 42


def test_ids_follow_the_order_over_many_tasks(spark):
    rows = spark.range(5000).select((F.hash("id")).alias("k"), "id")
    found = allocate_ids(rows, "new_id", ["k", "id"], start=10).orderBy("k", "id").collect()
    assert [r.new_id for r in found] == list(range(11, 5011))


def test_upsert_takes_the_last_update(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    updates = spark.createDataFrame([(2, "x", 1), (2, None, 2), (3, "c", 1)], "k int, v string, n long")
    found = {r.k: r.v for r in upsert_by_key(target, updates, ["k"], "n").collect()}
    assert found == {1: "a", 2: None, 3: "c"}


def test_merge_all_stores_in_order(spark):
    tables = StarTables(spark, scratch_path(spark, "star"))
    where = {"locality": "Monza", "country": "Italy"}
    sources = {
        "drivers": docs(spark, drivers("a", "b")),
        "constructors": docs(spark, {"MRData": {"ConstructorTable": {"Constructors": [{"constructorId": "red"}]}}}),
        "circuits": docs(spark, {"MRData": {"CircuitTable": {"Circuits": [{"circuitId": "monza", "Location": where}]}}}),
        "status": docs(spark, {"MRData": {"StatusTable": {"Status": [{"statusId": "77", "status": "Finished"}]}}}),
        "races": docs(spark, races(race("2024-03-03"))),
        "laps": docs(spark, lap_race(("a", "1", "1:30.0"), ("b", "1", "1:31.0"))),
        "driver_standings": docs(spark, {"MRData": {"StandingsTable": {"StandingsLists": [
            {"DriverStandings": [{"position": "1", "points": "25", "wins": "1", "Driver": {"driverId": "a"}}]}]}}}),
        "constructor_standings": docs(spark, {"MRData": {"StandingsTable": {"StandingsLists": [
            {"ConstructorStandings": [{"position": "1", "points": "25", "wins": "1", "Constructor": {"constructorId": "red"}}]}]}}}),
        "results": docs(spark, races(race("2024-03-03", Results=[
            {"position": "1", "points": "25", "laps": "9", "grid": "1", "status": "Finished",
             "Driver": {"driverId": d}, "Constructor": {"constructorId": "red"}} for d in "ab"]))),
    }
    merge_all(sources, tables)
    assert tables["raceStatusDim"].first().statusId == 1
    assert tables["lapsDim"].count() == 2
    # "b" has no standings row
    assert [(r.resultId, r.driverId) for r in tables["raceResultsFact"].collect()] == [(1, 1)]
    merge_all({k: v for k, v in sources.items() if k != "results"}, tables)
    assert tables["lapsDim"].count() == 2 and tables["driverDim"].count() == 2


@pytest.mark.parametrize("files", [1, 3])
def test_stream_equals_batch_and_survives_a_replay(spark, star, files):
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "star")
    tables = StarTables(spark, root)
    tables.append("driverDim", star["driverDim"])
    batch = [drivers("a", "old"), drivers("b", "a"), drivers("c", "b")]
    for value in batch:
        documents.write_documents(docs(spark, value).coalesce(1), landing)
    source = stream_folder(spark, landing, files_per_batch=files)
    merge_stream(source, LOADS["driverDim"], tables, scratch_path(spark, "offsets")).awaitTermination()
    expected = LOADS["driverDim"].new_rows(docs(spark, *batch), star)

    def state():
        return sorted((r.driverId, r.driverRef) for r in tables["driverDim"].collect())

    whole = star["driverDim"].unionByName(expected).collect()
    assert {r.driverRef for r in whole} == {ref for _, ref in state()}
    assert [i for i, _ in state()] == [3, 7, 8, 9, 10]
    # the same batches again from a new checkpoint: a writer of its own, and no key is new
    merge_stream(source, LOADS["driverDim"], tables, scratch_path(spark, "offsets")).awaitTermination()
    assert [i for i, _ in state()] == [3, 7, 8, 9, 10]


def test_late_parents_are_retried(spark):
    from datetime import date

    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "star")
    offsets = scratch_path(spark, "offsets")
    tables = StarTables(spark, root)
    load = LOADS["lapsDim"]

    def run():
        source = stream_folder(spark, landing)
        merge_stream(source, load, tables, offsets, retry_rejects=True).awaitTermination()
        return tables["lapsDim"].count()

    days = spark.createDataFrame([(11, date(2024, 3, 3))], "raceId long, date date")
    columns = [F.lit(None).alias(f.name) for f in tables["raceDim"].schema if f.name not in days.columns]
    tables.append("raceDim", days.select("*", *columns))
    documents.write_documents(docs(spark, lap_race(("late", "1", "1:30.0"))), landing)
    assert run() == 0
    one = spark.createDataFrame([(1, "late")], "driverId long, driverRef string")
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in tables["driverDim"].schema if f.name not in one.columns]
    tables.append("driverDim", one.select("*", *columns))
    documents.write_documents(docs(spark, lap_race(("late", "2", "1:31.0"))), landing)
    assert run() == 2


def test_records_of_documents(spark):
    status = {"MRData": {"StatusTable": {"Status": [{"statusId": "1", "status": "Finished"}]}}}
    records = as_records("status", docs(spark, status))
    text = documents.to_records(records).first().value
    assert json.loads(text) == {"statusId": 1, "status": "Finished"}


def drivers_named(tables):
    return sorted(r.driverRef for r in tables["driverDim"].collect())


def test_writers_do_not_replace_each_other(spark):
    tables = StarTables(spark, scratch_path(spark, "star"))
    load = LOADS["driverDim"]

    def stream(name, checkpoint):
        landing = scratch_path(spark, "landing")
        documents.write_documents(docs(spark, drivers(name)), landing)
        source = stream_folder(spark, landing)
        merge_stream(source, load, tables, checkpoint).awaitTermination()

    stream("s0", scratch_path(spark, "offsets"))
    merge_all({"drivers": docs(spark, drivers("batch_a"))}, tables)
    merge_all({"drivers": docs(spark, drivers("batch_b"))}, tables)
    stream("s1", scratch_path(spark, "offsets"))
    assert drivers_named(tables) == ["batch_a", "batch_b", "s0", "s1"]
    merge_all({"drivers": docs(spark, drivers("batch_c"))}, tables, batch=1)
    assert drivers_named(tables) == ["batch_a", "batch_c", "s0", "s1"]
    tables.compact("driverDim")
    assert drivers_named(tables) == ["batch_a", "batch_c", "s0", "s1"]
    assert tables.last_batch("driverDim") == 1


@pytest.mark.parametrize("upsert", [False, True])
def test_batch_counts_equal_the_audit(spark, upsert):
    """Counts taken while writing are those of the audit query; plain new rows take no job for them."""
    tables, load = StarTables(spark, scratch_path(spark, "star")), LOADS["driverDim"]
    wanted, jobs = {}, []
    batches = [
        docs(spark, drivers("a", "b", "c")),
        docs(spark, drivers("d", "e")),
        docs(spark, drivers("a", "e", "f", "f", "a", None), drivers(None)),
        docs(spark, drivers("a")),
        docs(spark, drivers()),
    ]
    for number, batch in enumerate(batches):
        known = tables.before("driverDim", number).select("driverRef").toPandas()
        target = spark.createDataFrame([(r,) for r in known["driverRef"]], "driverRef string")
        for r in merge_audit(load.incoming(batch, "reference"), target, load.spec).collect():
            wanted[r.outcome] = wanted.get(r.outcome, 0) + r.row_count
        group = f"counted {upsert} {number}"
        spark.sparkContext.setJobGroup(group, "one batch")
        merge_batch(load, batch, tables, number, upsert=upsert)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        spark.sparkContext.setJobGroup("rest", "other jobs")
    if upsert:
        wanted["updated"] = wanted.pop("exists")
    lost = {r.outcome: r.row_count for r in audit_of(tables).collect()}
    assert {k: lost[k] for k in wanted} == wanted and wanted["repeated"] >= 1
    if not upsert:  # a batch of known or lost rows asks for them, one of new rows does not
        assert jobs[1] < jobs[2]


def test_faulty_documents_are_kept_and_counted(spark):
    tables = StarTables(spark, scratch_path(spark, "star"))
    broken = spark.createDataFrame([("{oops",)], "value string")
    rows = docs(spark, drivers("a"), {"MRData": {}})
    rows = rows.unionByName(broken.withColumn("_seq", F.lit(9).cast(rows.schema["_seq"].dataType)))
    merge_all({"drivers": rows}, tables)
    counts = {(r.outcome, r.row_count) for r in audit_of(tables).collect()}
    assert counts == {("inserted", 1), ("malformed", 1), ("missing_path", 1)}
    with pytest.raises(Exception, match="no MRData"):
        merge_all({"drivers": rows}, tables, strict=True)


def test_topic_records_are_merged(spark):
    tables = StarTables(spark, scratch_path(spark, "star"))
    texts = [{"statusId": 1, "status": "Finished"}, {"statusId": 2}, {"statusId": 3, "status": "Engine"}]
    merge_all({"status": docs(spark, *texts)}, tables, forms={"status": "record"})
    assert {r.status for r in tables["raceStatusDim"].collect()} == {"Finished", "Engine"}
    outcomes = {(r.outcome, r.row_count) for r in audit_of(tables).collect()}
    assert outcomes == {("inserted", 2), ("missing_keys", 1)}
    with pytest.raises(ValueError, match="documents only"):
        as_records("laps", docs(spark, {}), form="record")


def test_every_reject_is_kept_and_parents_may_come_late(spark):
    from datetime import date

    tables = StarTables(spark, scratch_path(spark, "star"))
    load = LOADS["lapsDim"]
    days = spark.createDataFrame([(11, date(2024, 3, 3))], "raceId long, date date")
    columns = [F.lit(None).alias(f.name) for f in tables["raceDim"].schema if f.name not in days.columns]
    tables.append("raceDim", days.select("*", *columns))
    laps = lap_race(("late", "1", "1:30.0"), ("late", "2", "x:y:z"))
    merge_batch(load, docs(spark, laps), tables, 0)
    kept = spark.read.parquet(tables.place("_rejects/lapsDim", 0))
    assert {r._reason for r in kept.collect()} == {"missing_driver", "bad_time"}
    one = spark.createDataFrame([(1, "late")], "driverId long, driverRef string")
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in tables["driverDim"].schema if f.name not in one.columns]
    tables.append("driverDim", one.select("*", *columns))
    retry_rejects(load, tables, 0)
    assert tables["lapsDim"].count() == 1


def test_micro_batches_leave_no_staged_copies(spark):
    import os

    from gridstats.session import scratch_dir

    def staged():
        return [n for n in os.listdir(scratch_dir(spark)) if n.startswith("ids-")]

    tables = StarTables(spark, scratch_path(spark, "star"))
    known = set(staged())
    for number in range(3):
        merge_batch(LOADS["driverDim"], docs(spark, drivers(f"d{number}")), tables, number, "stream-x")
    assert drivers_named(tables) == ["d0", "d1", "d2"] and set(staged()) == known


def test_upsert_orders_by_any_type(spark):
    target = spark.createDataFrame([(1, "old"), (2, "keep")], "id long, name string")
    updates = spark.createDataFrame(
        [(1, "late", (0, 9)), (1, "early", (0, 2)), (3, "new", (1, 0))],
        "id long, name string, seq struct<p:int,o:int>",
    )
    found = upsert_by_key(target, updates, ["id"], "seq").collect()
    assert sorted(map(tuple, found)) == [(1, "late"), (2, "keep"), (3, "new")]
