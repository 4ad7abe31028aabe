"""Nested response documents flattened to records.

Every function takes documents (``value``, ``_seq``) and gives one row per element, with the
element's place in its document in ``_pos`` columns, so that arrival order can be rebuilt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import pit_seconds
from ..sources.documents import SEQ, has_path, parse_documents

# Where the list of each kind of whole document is.
LISTS = {
    "drivers": "MRData.DriverTable.Drivers",
    "circuits": "MRData.CircuitTable.Circuits",
    "constructors": "MRData.ConstructorTable.Constructors",
    "races": "MRData.RaceTable.Races",
    "status": "MRData.StatusTable.Status",
}
# And of the kinds whose documents nest it in races or standings.
PATHS = {
    **LISTS,
    **dict.fromkeys(("results", "laps", "pit_stops"), "MRData.RaceTable.Races"),
    **dict.fromkeys(
        ("driver_standings", "constructor_standings"), "MRData.StandingsTable.StandingsLists"
    ),
}
_RACES = "doc.MRData.RaceTable.Races"
_STANDINGS = "doc.MRData.StandingsTable.StandingsLists"


def _each(df: DataFrame, items: Column, name: str, place: str, *keep) -> DataFrame:
    return df.select(*keep, F.posexplode(items).alias(place, name))


def document_counts(docs: DataFrame, kind: str) -> DataFrame:
    """Per document, the number of elements in its list; 0 where the list is absent."""
    path = LISTS[kind]
    parsed = parse_documents(docs, kind)
    return parsed.select(SEQ, F.coalesce(F.size(f"doc.{path}"), F.lit(0)).alias("item_count"))


def calendar(docs: DataFrame) -> DataFrame:
    """The races of calendar documents."""
    parsed = parse_documents(docs, "races")
    return _each(parsed, F.col(_RACES), "race", "_pos", SEQ)


def results_for_calendar(calendar_docs: DataFrame, results_docs: DataFrame) -> DataFrame:
    """Per results document, how many of its races the calendar asks for."""
    wanted = calendar(calendar_docs).select("race.season", "race.round").distinct()
    parsed = parse_documents(results_docs, "results")
    races = _each(parsed, F.col(_RACES), "race", "_pos", SEQ)
    answered = races.select(SEQ, "race.season", "race.round").join(
        wanted, ["season", "round"], "left_semi"
    )
    return answered.groupBy(SEQ).agg(F.count(F.lit(1)).alias("race_count"))


def practice_sessions(docs: DataFrame) -> DataFrame:
    """Number of free practice sessions in all calendar documents."""
    sessions = ["FirstPractice", "SecondPractice", "ThirdPractice"]
    present = sum((F.col(f"race.{s}").isNotNull().cast("long") for s in sessions), F.lit(0))
    return calendar(docs).agg(F.coalesce(F.sum(present), F.lit(0)).alias("session_count"))


def lap_requests(docs: DataFrame) -> DataFrame:
    """The lap numbers to ask for, from documents that state a ``total``."""
    total = F.col("doc.MRData.total").try_cast("int")
    return (
        parse_documents(docs, "laps")
        .where(total > 0)
        .select(SEQ, F.explode(F.sequence(F.lit(1), total)).alias("lap"))
    )


def nonempty_lap_documents(docs: DataFrame) -> DataFrame:
    """Lap documents that hold at least one race, unchanged."""
    return parse_documents(docs, "laps").where(F.size(_RACES) > 0).drop("doc")


def flatten_laps(docs: DataFrame) -> DataFrame:
    """One row per race, lap and driver."""
    parsed = parse_documents(docs, "laps")
    races = _each(parsed, F.col(_RACES), "race", "_pos", SEQ)
    laps = _each(races, F.col("race.Laps"), "lap", "_pos2", SEQ, "_pos", "race.date")
    timings = _each(
        laps, F.col("lap.Timings"), "t", "_pos3", SEQ, "_pos", "_pos2", "date", "lap.number"
    )
    return timings.select(
        SEQ,
        "_pos",
        "_pos2",
        "_pos3",
        "date",
        F.col("number").alias("lap"),
        "t.driverId",
        "t.time",
        "t.position",
    )


def flatten_pit_stops(docs: DataFrame, mode: str = "reference") -> DataFrame:
    """Pit stop records. ``reference`` leaves a duration without minutes null."""
    parsed = parse_documents(docs, "pit_stops")
    races = _each(parsed, F.col(_RACES), "race", "_pos", SEQ)
    stops = _each(
        races, F.col("race.PitStops"), "s", "_pos2", SEQ, "_pos", "race.season", "race.round"
    )
    return stops.select(
        SEQ,
        "_pos",
        "_pos2",
        "season",
        "round",
        "s.driverId",
        F.col("s.stop").try_cast("int").alias("stop"),
        F.col("s.lap").try_cast("int").alias("lap_pitstops"),
        F.col("s.time").alias("time_pitstops"),
        pit_seconds(F.col("s.duration"), mode).alias("duration"),
    )


def flatten_status(docs: DataFrame) -> DataFrame:
    """Finish status records."""
    parsed = parse_documents(docs, "status")
    items = _each(parsed, F.col(f"doc.{LISTS['status']}"), "s", "_pos", SEQ)
    return items.select(
        SEQ, "_pos", F.col("s.statusId").try_cast("int").alias("statusId"), "s.status"
    )


def _standings(docs: DataFrame, kind: str, field: str, who: str) -> DataFrame:
    parsed = parse_documents(docs, kind)
    first = F.try_element_at(F.col(_STANDINGS), F.lit(1))
    items = _each(parsed, first[field], "s", "_pos", SEQ)
    return items.select(
        SEQ,
        "_pos",
        F.col(f"s.{who}").alias(who.split(".")[1]),
        F.col("s.position").try_cast("int").alias("position"),
        F.col("s.points").try_cast("double").alias("points"),
        F.col("s.wins").try_cast("int").alias("wins"),
    )


def flatten_driver_standings(docs: DataFrame) -> DataFrame:
    """Driver standings of the first list of every document; empty documents give nothing."""
    return _standings(docs, "driver_standings", "DriverStandings", "Driver.driverId")


def flatten_constructor_standings(docs: DataFrame) -> DataFrame:
    """Team standings of the first list of every document; empty documents give nothing."""
    return _standings(
        docs, "constructor_standings", "ConstructorStandings", "Constructor.constructorId"
    )


def flatten_results(docs: DataFrame) -> DataFrame:
    """Result records; absent ``Time`` and ``FastestLap`` parts become null."""
    parsed = parse_documents(docs, "results")
    races = _each(parsed, F.col(_RACES), "race", "_pos", SEQ)
    items = _each(
        races, F.col("race.Results"), "r", "_pos2", SEQ, "_pos", "race.round", "race.date"
    )
    return items.select(
        SEQ,
        "_pos",
        "_pos2",
        "round",
        "date",
        "r.Constructor.constructorId",
        "r.Driver.driverId",
        F.col("r.status").alias("statusId"),
        F.col("r.position").alias("positionOrder"),
        F.col("r.points").try_cast("double").alias("points"),
        F.col("r.laps").try_cast("int").alias("laps"),
        F.col("r.grid").try_cast("int").alias("grid"),
        F.col("r.FastestLap.Time.time").alias("fastestLapTime"),
        F.col("r.FastestLap.AverageSpeed.speed").try_cast("double").alias("fastestLapSpeed"),
        F.col("r.Time.time").alias("time"),
        F.col("r.FastestLap.lap").try_cast("int").alias("fastestLap"),
    )


def document_report(docs: DataFrame, kind: str) -> DataFrame:
    """How many documents hold their list and how many do not."""
    state = F.when(has_path(LISTS[kind]), "valid").otherwise("missing_path")
    return docs.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("document_count"))
