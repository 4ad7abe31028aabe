"""The manifest, buckets, leases, updates, and the stream of all tables."""

import itertools
import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from gridstats.plans.loads import LOADS, merge_all, merge_batch
from gridstats.session import scratch_path
from gridstats.sources import manifest as manifests
from gridstats.sources import tables as storage
from gridstats.sources.tables import StarTables
from gridstats.sources.topics import stream_messages, write_messages
from gridstats.streaming.merge_stream import merge_all_stream

TEAM = "constructorDim"


@pytest.fixture
def tables(spark):
    return StarTables(spark, scratch_path(spark, "star"))


def teams(spark, *refs, start=1, name="N"):
    rows = [(start + n, r, name, None, None) for n, r in enumerate(refs)]
    schema = "constructorId long, constructorRef string, name string, nationality_constructors string, url_constructors string"
    return spark.createDataFrame(rows, schema)


def team_docs(spark, *refs, name="N"):
    items = [{"constructorId": r, "name": name} for r in refs]
    text = json.dumps({"MRData": {"ConstructorTable": {"Constructors": items}}})
    return spark.createDataFrame([(text, 0)], "value string, _seq long")


def stored(tables):
    return sorted((r.constructorId, r.constructorRef) for r in tables[TEAM].collect())


class Stopped(Exception):
    pass


def test_compact_may_stop_after_every_step(spark, tables, monkeypatch):
    for n in range(3):
        tables.append(TEAM, teams(spark, f"a{n}", f"b{n}", start=2 * n))
    rows = stored(tables)
    steps = {
        (StarTables, "_rows"), (StarTables, "_store"), (manifests.Manifest, "_publish"), (storage, "_remove"),
    }
    for (owner, step), late in itertools.product(sorted(steps, key=str), (False, True)):
        again = getattr(owner, step)

        def stop(*args, step=again, late=late, **more):
            if late:
                step(*args, **more)
            raise Stopped

        with monkeypatch.context() as patch:
            patch.setattr(owner, step, stop)
            try:
                tables.compact(TEAM)
                tables.clean(TEAM, keep_versions=0)
            except Stopped:
                pass
        assert stored(tables) == rows
    tables.compact(TEAM)
    tables.clean(TEAM, keep_versions=0)
    assert stored(tables) == rows and len(tables.manifest(TEAM).read().parts) == 1
    tables.append(TEAM, teams(spark, "z", start=90))
    assert stored(tables) == [*rows, (90, "z")]


def test_a_reader_keeps_its_version(spark, tables):
    tables.append(TEAM, teams(spark, "a"))
    tables.append(TEAM, teams(spark, "b", start=2))
    before = tables[TEAM]
    tables.compact(TEAM)
    tables.append(TEAM, teams(spark, "c", start=3), batch=0)
    assert sorted(r.constructorRef for r in before.collect()) == ["a", "b"]


def test_two_writers_publish_one_after_the_other(spark, tables):
    manifest = tables.manifest(TEAM)
    starts = []

    def lease(writer):
        for batch in range(4):
            starts.append(manifest.lease_ids(writer, batch, 5))

    threads = [threading.Thread(target=lease, args=(f"w{n}",)) for n in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(starts) == list(range(0, 60, 5))
    assert manifest.lease_ids("w0", 3, 5) in starts  # the same again when it is tried again
    assert manifest.read().version == 12


def test_interleaved_loads_give_disjoint_ids(spark, tables, monkeypatch):
    tables.append(TEAM, teams(spark, "old", start=7))
    write, inner = StarTables.write_batch, []

    def late(self, table, rows, *args):
        if not inner:  # another load starts and ends after this one drew its ids
            inner.append(1)
            merge_batch(LOADS[TEAM], team_docs(spark, "x", "y"), tables, 0, "other")
        write(self, table, rows, *args)

    monkeypatch.setattr(StarTables, "write_batch", late)
    merge_batch(LOADS[TEAM], team_docs(spark, "a", "b"), tables, 0, "one")
    found = stored(tables)
    assert [i for i, _ in found] == [7, 8, 9, 10, 11]
    assert {r for _, r in found} == {"old", "a", "b", "x", "y"}


def test_a_batch_reads_only_the_buckets_of_its_keys(spark, monkeypatch):
    monkeypatch.setattr(storage, "BUCKET_ROWS", 64)
    key = LOADS[TEAM].spec.key
    keys = teams(spark, "t3", "t77").select(*key)
    read = []
    for size, buckets in ((400, 8), (1600, 32)):
        tables = StarTables(spark, scratch_path(spark, "star"))
        known = spark.range(size).select(
            F.col("id").alias("constructorId"), F.concat(F.lit("t"), "id").alias("constructorRef"),
            F.sha2(F.col("id").cast("string"), 512).alias("name"), F.lit(None).cast("string").alias("nationality_constructors"),
            F.lit(None).cast("string").alias("url_constructors"),
        )
        tables.write_batch(TEAM, known.limit(size - 1), 0, "load", key)
        tables.write_batch(TEAM, known.where(f"id = {size - 1}").withColumn("constructorRef", F.lit(None).cast("string")), 1, "load", key)
        tables.compact(TEAM)
        parts = tables.manifest(TEAM).read().parts
        assert [p.buckets for p in parts] == [buckets]
        pruned = tables.before(TEAM, keys=keys)
        assert pruned.join(keys, list(key)).count() == 2
        read.append((bytes_read_by(spark, pruned), bytes_read_by(spark, tables[TEAM])))
    (small, small_whole), (large, large_whole) = read
    assert large_whole > 3 * small_whole and large < 1.5 * small
    # a key with a null part is in no bucket, and is there
    assert tables[TEAM].where("constructorRef IS NULL").count() == 1


def bytes_read_by(spark, frame):
    """Sizes of the files that the scan reads, by its partition filters."""
    paths = {r[0] for r in frame.select(F.input_file_name()).distinct().collect()}
    return sum(os.path.getsize(p.removeprefix("file://")) for p in paths)


def test_streams_settle_their_batches(spark, tables, monkeypatch):
    monkeypatch.setattr(storage, "FAN", 3)
    for n in range(7):
        tables.write_batch(TEAM, teams(spark, f"t{n}", start=n), n, "s", ("constructorRef",))
        tables.settle(TEAM, "s", n)
    parts = tables.manifest(TEAM).read().parts
    assert len(parts) <= 4 and max(p.last for p in parts) == 6
    assert [r for _, r in stored(tables)] == [f"t{n}" for n in range(7)]
    # the newest batch stays on its own, so it can be repeated
    tables.write_batch(TEAM, teams(spark, "t6b", start=6), 6, "s", ("constructorRef",))
    assert [r for _, r in stored(tables)][-1] == "t6b" and len(stored(tables)) == 7
    assert tables.last_batch(TEAM, "s") == 6


def test_upsert_keeps_ids_and_untouched_buckets(spark, tables, monkeypatch):
    monkeypatch.setattr(storage, "BUCKET_ROWS", 8)
    key = LOADS[TEAM].spec.key
    tables.write_batch(TEAM, teams(spark, *[f"t{n}" for n in range(60)]), 0, "load", key)
    tables.compact(TEAM)
    before = {r.constructorRef: r for r in tables[TEAM].collect()}
    paths = {p[0] for p in tables[TEAM].select(F.input_file_name()).distinct().collect()}
    for _ in range(2):  # once more changes nothing
        merge_all({"constructors": team_docs(spark, "t5", "new", "t5", name="M")}, tables, batch=1, upsert=[TEAM])
        after = {r.constructorRef: r for r in tables[TEAM].collect()}
        assert len(after) == tables[TEAM].count() == 61
        assert after["t5"].constructorId == before["t5"].constructorId and after["t5"].name == "M"
        assert after["new"].constructorId == 61 and after["new"].name == "M"
        assert all(after[r] == before[r] for r in before if r != "t5")
        left = {p[0] for p in tables[TEAM].select(F.input_file_name()).distinct().collect()}
        assert len(paths & left) >= len(paths) - 2
    tables.compact(TEAM)
    assert {r.constructorRef: r for r in tables[TEAM].collect()} == after
    with pytest.raises(ValueError, match="no natural key"):
        merge_batch(LOADS["driverStandingsDim"], team_docs(spark, "x"), tables, 0, upsert=True)


# -- one stream for all tables ----------------------------------------------------------------


def message(source, path, items):
    value = items
    for step in reversed(path.split(".")):
        value = {step: value}
    return source, json.dumps(value)


def small_season():
    drivers = [{"driverId": d, "familyName": d.upper()} for d in "abc"]
    where = {"locality": "Monza", "country": "Italy"}
    race = {"season": "2024", "round": "3", "date": "2024-03-03", "raceName": "R", "url": "u", "Circuit": {"circuitId": "monza"}}
    timings = [{"driverId": d, "position": "1", "time": "1:30.0"} for d in "ab"]
    results = [
        {"position": "1", "points": "25", "laps": "9", "grid": "1", "status": "Finished",
         "Driver": {"driverId": d}, "Constructor": {"constructorId": "red"}} for d in "ab"
    ]
    standing = {"position": "1", "points": "25", "wins": "1"}
    return [
        message("results", "MRData.RaceTable.Races", [{**race, "Results": results}]),
        message("laps", "MRData.RaceTable.Races", [{**race, "Laps": [{"number": "1", "Timings": timings}]}]),
        message("races", "MRData.RaceTable.Races", [race]),
        message("driver_standings", "MRData.StandingsTable.StandingsLists",
                [{"DriverStandings": [{**standing, "Driver": {"driverId": d}} for d in "ab"]}]),
        message("constructor_standings", "MRData.StandingsTable.StandingsLists",
                [{"ConstructorStandings": [{**standing, "Constructor": {"constructorId": "red"}}]}]),
        message("circuits", "MRData.CircuitTable.Circuits", [{"circuitId": "monza", "Location": where}]),
        message("constructors", "MRData.ConstructorTable.Constructors", [{"constructorId": "red"}]),
        message("status", "MRData.StatusTable.Status", [{"statusId": "1", "status": "Finished"}]),
        message("drivers", "MRData.DriverTable.Drivers", drivers),
    ]


def named_rows(tables):
    """What the star says, by names instead of ids."""
    names = {r.driverId: r.driverRef for r in tables["driverDim"].collect()}
    days = {r.raceId: str(r.date) for r in tables["raceDim"].collect()}
    return {
        "drivers": sorted(names.values()),
        "races": sorted(days.values()),
        "laps": sorted((days[r.raceId], names[r.driverId], r.lap, r.milliseconds_laptimes) for r in tables["lapsDim"].collect()),
        "results": sorted((days[r.raceId], names[r.driverId], r.points) for r in tables["raceResultsFact"].collect()),
        "practice": sorted(days[r.raceId] for r in tables["freePracticeDim"].collect()),
        "standings": tables["driverStandingsDim"].count() + tables["constructorStandingsDim"].count(),
    }


def test_one_stream_fills_all_tables_in_any_order(spark):
    season = small_season()
    whole = StarTables(spark, scratch_path(spark, "star"))
    merge_all({s: spark.createDataFrame([(v, 0)], "value string, _seq long") for s, v in season}, whole)
    expected = named_rows(whole)
    assert len(expected["laps"]) == len(expected["results"]) == 2
    # children first, three messages at a time; and one that no table takes
    tables, landing = StarTables(spark, scratch_path(spark, "star")), scratch_path(spark, "landing")
    for source, value in season:
        write_messages(spark.createDataFrame([(value,)], "value string").coalesce(1), source, landing)
    write_messages(spark.createDataFrame([("{}",)], "value string"), "weather", landing)
    offsets = scratch_path(spark, "offsets")
    for _ in range(2):  # drained once more it changes nothing
        merge_all_stream(stream_messages(spark, landing, 3), tables, offsets).awaitTermination()
        assert named_rows(tables) == expected
    lost = spark.read.option("recursiveFileLookup", True).parquet(f"{tables.root}/_faults/unknown_source")
    assert [r.source for r in lost.collect()] == ["weather"]


def test_staged_messages_are_read_by_kind_alone(spark, monkeypatch):
    """One kind's messages are read without those of the others, dealt to tasks as if alone."""
    from gridstats.streaming import merge_stream as streams

    season, seen = small_season(), {}

    def held(load, rows, *rest, **more):
        seen[load.source] = rows._jdf.queryExecution().executedPlan().toString()

    tables, landing = StarTables(spark, scratch_path(spark, "star")), scratch_path(spark, "landing")
    for source, value in season:
        write_messages(spark.createDataFrame([(value,)], "value string"), source, landing, compression="gzip")
    monkeypatch.setattr(streams, "merge_batch", held)
    streams.merge_all_stream(
        stream_messages(spark, landing), tables, scratch_path(spark, "offsets")
    ).awaitTermination()
    assert seen
    for source, plan in seen.items():
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert f"= {source})" in filters


def test_a_batch_builds_its_documents_once(spark):
    """What documents come from is done once, for the rows and for the faults."""
    from pyspark.sql import functions as F

    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(name):
        made.add(1)
        return '{"MRData": {"StatusTable": {"Status": [{"statusId": "1", "status": "%s"}]}}}' % name

    rows = spark.range(3, numPartitions=1).select(
        text(F.col("id").cast("string")).alias("value"), F.col("id").alias("_seq")
    )
    tables = StarTables(spark, scratch_path(spark, "star"))
    merge_all({"status": rows}, tables)
    assert tables["raceStatusDim"].count() == 3
    assert made.value == 3
