"""Response documents over the roles.

A document holds a block of neighbouring keys, as the pages of the public API do, so no document
grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .roles import LAP_TEXT, PIT_CLOCK, Roles

ENTITIES_PER_DOCUMENT = 30
ORDERS_PER_DOCUMENT = 50


def _list_of(items: Column, *order: str) -> Column:
    """The items of a group in a fixed order."""
    keyed = F.struct(*[F.col(o) for o in order], items.alias("_item"))
    return F.transform(F.array_sort(F.collect_list(keyed)), lambda pair: pair["_item"])


def _wrap(items: Column, *path: str) -> Column:
    """``items`` below a dotted path, as JSON text."""
    for name in reversed(path):
        items = F.struct(items.alias(name))
    return F.to_json(items)


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _block(key: str, size: int) -> Column:
    return F.floor(F.col(key) / size).alias("_seq")


def driver_documents(roles: Roles) -> DataFrame:
    item = F.struct(
        F.col("driverRef").alias("driverId"),
        _text("number").alias("permanentNumber"),
        "code",
        "url",
        F.col("forename").alias("givenName"),
        F.col("surname").alias("familyName"),
        _text("dob").alias("dateOfBirth"),
        "nationality",
    )
    grouped = roles["driverDim"].groupBy(_block("driverId", ENTITIES_PER_DOCUMENT))
    items = grouped.agg(_list_of(item, "driverId").alias("_items"))
    value = _wrap(F.col("_items"), "MRData", "DriverTable", "Drivers")
    return items.select("_seq", value.alias("value"))


def circuit_documents(roles: Roles) -> DataFrame:
    """One circuit has no locality and one has no country."""
    key = F.col("circuitId")
    item = F.struct(
        F.col("circuitRef").alias("circuitId"),
        F.col("name_y").alias("circuitName"),
        F.col("url_y").alias("url"),
        F.struct(
            _text("lat").alias("lat"),
            _text("lng").alias("long"),
            F.when(key == 24, F.lit("")).otherwise(F.col("location")).alias("locality"),
            F.when(key != 23, F.col("country")).alias("country"),
        ).alias("Location"),
    )
    grouped = roles["circuitDim"].groupBy(_block("circuitId", 10))
    items = grouped.agg(_list_of(item, "circuitId").alias("_items"))
    value = _wrap(F.col("_items"), "MRData", "CircuitTable", "Circuits")
    return items.select("_seq", value.alias("value"))


def constructor_documents(roles: Roles) -> DataFrame:
    item = F.struct(
        F.col("constructorRef").alias("constructorId"),
        F.col("url_constructors").alias("url"),
        "name",
        F.col("nationality_constructors").alias("nationality"),
    )
    grouped = roles["constructorDim"].groupBy(_block("constructorId", ENTITIES_PER_DOCUMENT))
    items = grouped.agg(_list_of(item, "constructorId").alias("_items"))
    value = _wrap(F.col("_items"), "MRData", "ConstructorTable", "Constructors")
    return items.select("_seq", value.alias("value"))


def calendar_documents(roles: Roles) -> DataFrame:
    """One calendar per season, a race per day at most."""

    def session(short: str) -> Column:
        date, time = f"{short}_date", f"{short}_time"
        pair = F.struct(_text(date).alias("date"), F.col(time).alias("time"))
        return F.when(F.col(date).isNotNull(), pair)

    rows = (
        roles["raceDim"]
        .join(roles["freePracticeDim"], "raceId")
        .join(roles["circuitDim"].select("circuitId", "circuitRef"), "circuitId")
    )
    item = F.struct(
        _text("year").alias("season"),
        _text("round").alias("round"),
        F.col("name_x").alias("raceName"),
        F.col("url_x").alias("url"),
        _text("date").alias("date"),
        F.when(F.col("raceId") % 7 != 0, F.col("time_races")).alias("time"),
        F.struct(F.col("circuitRef").alias("circuitId")).alias("Circuit"),
        session("fp1").alias("FirstPractice"),
        session("fp2").alias("SecondPractice"),
        session("fp3").alias("ThirdPractice"),
    )
    items = rows.groupBy(F.col("year").cast("long").alias("_seq")).agg(
        _list_of(item, "raceId").alias("_items")
    )
    value = _wrap(F.col("_items"), "MRData", "RaceTable", "Races")
    return items.select("_seq", value.alias("value"))


def _in_blocks(
    roles: Roles, rows: DataFrame, item: Column, key: str, files: int | None
) -> DataFrame:
    """The items of every block of order keys, as ``_items``.

    ``files`` deals the blocks to as many tasks, in order, so that what the tasks write is in arrival
    order by file name and then by line. The rows are shuffled once either way.
    """
    rows = rows.withColumn("_seq", _block(key, ORDERS_PER_DOCUMENT))
    by = ["_seq"]
    if files:
        top = roles.read("orders").agg(F.max(_block("o_orderkey", ORDERS_PER_DOCUMENT))).first()[0] or 0
        rows = rows.withColumn("_file", F.floor(F.col("_seq") * files / (top + 1)).cast("int"))
        rows, by = rows.repartitionById(files, "_file"), ["_file", "_seq"]
    items = rows.groupBy(*by).agg(_list_of(item, key).alias("_items"))
    return items.sortWithinPartitions("_seq") if files else items


def _race_documents(
    roles: Roles, orders: DataFrame, race: Column, files: int | None = None
) -> DataFrame:
    items = _in_blocks(roles, orders, race, "o_orderkey", files)
    value = _wrap(F.col("_items"), "MRData", "RaceTable", "Races")
    return items.select("_seq", value.alias("value"))


def _season_round() -> list[Column]:
    return [
        F.year("day").cast("string").alias("season"),
        F.dayofyear("day").cast("string").alias("round"),
        F.col("day").cast("string").alias("date"),
    ]


def _references(roles: Roles) -> DataFrame:
    return roles["driverDim"].select("driverId", F.col("driverRef").alias("ref"))


def results_documents(roles: Roles, files: int | None = None) -> DataFrame:
    """One race per order; two in three seasons' documents lack some optional parts."""
    return _race_documents(roles, *_result_races(roles), files)


def results_pages(roles: Roles) -> DataFrame:
    """The same races as pages (season, round, value) of one round each."""
    rows, race = _result_races(roles)
    page = [F.year("day").alias("season"), F.dayofyear("day").alias("round"), _block("o_orderkey", ORDERS_PER_DOCUMENT)]
    items = rows.groupBy(*page).agg(_list_of(race, "o_orderkey").alias("_items"))
    value = _wrap(F.col("_items"), "MRData", "RaceTable", "Races")
    return items.select("season", "round", value.alias("value"))


def _result_races(roles: Roles) -> tuple[DataFrame, Column]:
    rows = (
        roles["raceResultsFact"]
        .join(roles["raceDim"].select("raceId", F.col("date").alias("day")), "raceId")
        .join(roles["raceStatusDim"], "statusId")
        .join(roles.teams_of_orders().select("constructorId", "constructorRef"), "constructorId")
        .join(_references(roles), "driverId")
        .withColumn("o_orderkey", F.col("resultId"))
    )
    lap = F.struct(
        _text("fastestLap").alias("lap"),
        F.struct(F.col("fastestLapTime").alias("time")).alias("Time"),
        F.when(
            F.col("positionOrder") != 12, F.struct(_text("fastestLapSpeed").alias("speed"))
        ).alias("AverageSpeed"),
    )
    result = F.struct(
        _text("positionOrder").alias("position"),
        _text("points").alias("points"),
        _text("grid").alias("grid"),
        _text("laps").alias("laps"),
        "status",
        F.struct(F.col("ref").alias("driverId")).alias("Driver"),
        F.struct(F.col("constructorRef").alias("constructorId")).alias("Constructor"),
        F.when(F.col("time").isNotNull(), F.struct("time")).alias("Time"),
        F.when(F.col("fastestLapTime").isNotNull(), lap).alias("FastestLap"),
    )
    return rows, F.struct(*_season_round(), F.array(result).alias("Results"))


def _orders_with_lines(roles: Roles, item: Column, name: str) -> DataFrame:
    """Every order with its lines as a list; an order's lines are few.

    Orders get their driver before they meet their lines, so the lines are shuffled once.
    """
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    orders = roles.orders().select("o_orderkey", "o_custkey", "day")
    named = orders.join(_references(roles), F.col("o_custkey") == F.col("driverId"))
    lines = roles.read("lineitem").join(named, F.expr("l_orderkey = o_orderkey"))
    return lines.groupBy("o_orderkey", "day", "ref").agg(_list_of(item, *order).alias(name))


def laps_documents(roles: Roles, files: int | None = None) -> DataFrame:
    timing = F.struct(
        F.col("ref").alias("driverId"),
        (F.col("l_suppkey") % 20 + 1).cast("string").alias("position"),
        F.expr(LAP_TEXT).alias("time"),
    )
    lap = F.struct(_text("l_linenumber").alias("number"), F.array(timing).alias("Timings"))
    rows = _orders_with_lines(roles, lap, "Laps")
    return _race_documents(roles, rows, F.struct(*_season_round(), "Laps"), files)


def pit_documents(roles: Roles, files: int | None = None) -> DataFrame:
    """Even stops state their duration in minutes, odd ones in plain seconds."""
    plain = F.col("l_quantity").cast("string")
    seconds = F.lpad(F.col("l_quantity").cast("int").cast("string"), 2, "0")
    clock = F.concat(F.lit("1:"), seconds, F.lit(".500"))
    stop = F.struct(
        F.col("ref").alias("driverId"),
        _text("l_linenumber").alias("stop"),
        (F.col("l_partkey") % 50 + 1).cast("string").alias("lap"),
        F.expr(PIT_CLOCK).alias("time"),
        F.when(F.col("l_linenumber") % 2 == 0, clock).otherwise(plain).alias("duration"),
    )
    rows = _orders_with_lines(roles, stop, "PitStops")
    return _race_documents(roles, rows, F.struct(*_season_round(), "PitStops"), files)


def status_documents(roles: Roles) -> DataFrame:
    item = F.struct(_text("statusId").alias("statusId"), "status")
    items = roles["raceStatusDim"].groupBy(F.lit(0).cast("long").alias("_seq"))
    items = items.agg(_list_of(item, "statusId").alias("_items"))
    value = _wrap(F.col("_items"), "MRData", "StatusTable", "Status")
    return items.select("_seq", value.alias("value"))


def driver_standings_documents(roles: Roles, files: int | None = None) -> DataFrame:
    """Every eleventh document has an empty standings list."""
    rows = roles["driverStandingsDim"].join(_references(roles), "driverId")
    item = F.struct(
        _text("position_driverstandings").alias("position"),
        _text("points_driverstandings").alias("points"),
        F.coalesce(_text("wins"), F.lit("0")).alias("wins"),
        F.struct(F.col("ref").alias("driverId")).alias("Driver"),
    )
    return _standings_documents(roles, rows, item, "driverStandingsId", "DriverStandings", files)


def constructor_standings_documents(roles: Roles, files: int | None = None) -> DataFrame:
    """Every eleventh document has an empty standings list."""
    refs = roles.teams_of_orders().select("constructorId", "constructorRef")
    rows = roles["constructorStandingsDim"].join(refs, "constructorId")
    item = F.struct(
        _text("position_constructorstandings").alias("position"),
        _text("points_constructorstandings").alias("points"),
        F.coalesce(_text("wins_constructorstandings"), F.lit("0")).alias("wins"),
        F.struct(F.col("constructorRef").alias("constructorId")).alias("Constructor"),
    )
    key, name = "constructorStandingsId", "ConstructorStandings"
    return _standings_documents(roles, rows, item, key, name, files)


def _standings_documents(
    roles: Roles, rows: DataFrame, item: Column, key: str, name: str, files: int | None
) -> DataFrame:
    items = _in_blocks(roles, rows, item, key, files)
    lists = F.array(F.struct(F.col("_items").alias(name)))
    full = F.when(F.col("_seq") % 11 != 10, lists).otherwise(F.slice(lists, 1, 0))
    value = _wrap(full, "MRData", "StandingsTable", "StandingsLists")
    return items.select("_seq", value.alias("value"))


def flawed(docs: DataFrame) -> DataFrame:
    """The documents, every eleventh with its table renamed so that its path is missing."""
    broken = F.replace("value", F.lit("RaceTable"), F.lit("NoTable"))
    return docs.withColumn(
        "value", F.when(F.col("_seq") % 11 == 10, broken).otherwise(F.col("value"))
    )


ALL = {
    "drivers": driver_documents,
    "circuits": circuit_documents,
    "constructors": constructor_documents,
    "races": calendar_documents,
    "results": results_documents,
    "laps": laps_documents,
    "pit_stops": pit_documents,
    "status": status_documents,
    "driver_standings": driver_standings_documents,
    "constructor_standings": constructor_standings_documents,
}

# Kinds of which there are as many documents as orders need: these can be dealt to files in order.
BY_ORDER = ("results", "laps", "pit_stops", "driver_standings", "constructor_standings")


def landed(roles: Roles, kind: str, files: int) -> DataFrame:
    """Documents as they are landed: those that grow with the orders come from ``files`` tasks."""
    return ALL[kind](roles, files) if kind in BY_ORDER else ALL[kind](roles).coalesce(files)
