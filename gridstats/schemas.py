"""Fixed schemas: the thirteen star tables, the wide file, and the JSON documents."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "date": T.DateType(),
}


def _struct(spec: str) -> T.StructType:
    fields = []
    for item in spec.split(","):
        name, kind = item.split()
        fields.append(T.StructField(name, _TYPES[kind], True))
    return T.StructType(fields)


# Table and column names, in stored order. Ids are long so that a surrogate
# sequence cannot run out; a time of day is kept as text.
TABLES: dict[str, T.StructType] = {
    "driverDim": _struct(
        "driverId long, driverRef string, forename string, surname string, dob date,"
        " nationality string, code string, number int, url string"
    ),
    "constructorDim": _struct(
        "constructorId long, constructorRef string, name string,"
        " nationality_constructors string, url_constructors string"
    ),
    "circuitDim": _struct(
        "circuitId long, name_y string, circuitRef string, location string, country string,"
        " lat double, lng double, alt double, url_y string"
    ),
    "raceDim": _struct(
        "raceId long, circuitId long, name_x string, date date, year int, round int,"
        " time_races string, url_x string"
    ),
    "raceStatusDim": _struct("statusId long, status string"),
    "driverStandingsDim": _struct(
        "driverStandingsId long, driverId long, position_driverstandings int,"
        " points_driverstandings double, wins int"
    ),
    "constructorStandingsDim": _struct(
        "constructorStandingsId long, constructorId long, position_constructorstandings int,"
        " wins_constructorstandings int, points_constructorstandings double"
    ),
    "pitStopsDim": _struct(
        "raceId long, driverId long, stop int, lap_pitstops int, time_pitstops string,"
        " duration double"
    ),
    "lapsDim": _struct(
        "raceId long, driverId long, lap int, time_laptimes string,"
        " milliseconds_laptimes double, position_laptimes int"
    ),
    "qualificationsDim": _struct("raceId long, driverId long, quali_time string, quali_date date"),
    "freePracticeDim": _struct(
        "raceId long, fp1_date date, fp2_date date, fp3_date date, fp1_time string,"
        " fp2_time string, fp3_time string"
    ),
    "sprintDim": _struct("raceId long, driverId long, sprint_date date, sprint_time string"),
    "raceResultsFact": _struct(
        "resultId long, raceId long, constructorId long, driverId long,"
        " constructorStandingsId long, driverStandingsId long, statusId long,"
        " positionOrder int, points double, laps int, grid int, fastestLapTime string,"
        " fastestLapSpeed double, time string, fastestLap int"
    ),
}

# Primary key of each keyed table.
PRIMARY_KEYS = {
    "driverDim": "driverId",
    "constructorDim": "constructorId",
    "circuitDim": "circuitId",
    "raceDim": "raceId",
    "raceStatusDim": "statusId",
    "driverStandingsDim": "driverStandingsId",
    "constructorStandingsDim": "constructorStandingsId",
    "raceResultsFact": "resultId",
}

# Declared references as (child, column, parent, parent column).
REFERENCES = (
    ("raceResultsFact", "raceId", "raceDim", "raceId"),
    ("raceResultsFact", "constructorId", "constructorDim", "constructorId"),
    ("raceResultsFact", "driverId", "driverDim", "driverId"),
    (
        "raceResultsFact",
        "constructorStandingsId",
        "constructorStandingsDim",
        "constructorStandingsId",
    ),
    ("raceResultsFact", "driverStandingsId", "driverStandingsDim", "driverStandingsId"),
    ("raceDim", "circuitId", "circuitDim", "circuitId"),
    ("raceResultsFact", "statusId", "raceStatusDim", "statusId"),
    ("pitStopsDim", "raceId", "raceResultsFact", "raceId"),
    ("pitStopsDim", "driverId", "raceResultsFact", "driverId"),
    ("lapsDim", "raceId", "raceResultsFact", "raceId"),
    ("lapsDim", "driverId", "raceResultsFact", "driverId"),
    ("qualificationsDim", "raceId", "raceResultsFact", "raceId"),
    ("qualificationsDim", "driverId", "raceResultsFact", "driverId"),
    ("freePracticeDim", "raceId", "raceResultsFact", "raceId"),
    ("sprintDim", "raceId", "raceResultsFact", "raceId"),
    ("sprintDim", "driverId", "raceResultsFact", "driverId"),
    ("driverStandingsDim", "driverId", "raceResultsFact", "driverId"),
    ("constructorStandingsDim", "constructorId", "constructorDim", "constructorId"),
)

# Columns of the wide file that are read as numbers wherever they hold one, and
# columns that are dropped after reading.
COERCED_COLUMNS = (
    "position",
    "fastestLap",
    "fastestLapSpeed",
    "alt",
    "duration",
    "milliseconds_laptimes",
    "milliseconds",
    "circuitId",
    "milliseconds_pitstops",
)
DROPPED_COLUMNS = (
    "positionText",
    "positionText_driverstandings",
    "positionText_constructorstandings",
    "number_drivers",
    "milliseconds_pitstops",
)

ORDER_COLUMN = "_ord"


def wide_types() -> dict[str, T.DataType]:
    """Target type of every column of the wide file, row index first."""
    types: dict[str, T.DataType] = {ORDER_COLUMN: T.LongType()}
    for schema in TABLES.values():
        for field in schema:
            types.setdefault(field.name, field.dataType)
    types["position"] = T.DoubleType()
    types["milliseconds"] = T.DoubleType()
    for name in DROPPED_COLUMNS:
        types[name] = T.StringType()
    return types


def wide_text_schema() -> T.StructType:
    """The wide file as read: every column is text."""
    return T.StructType([T.StructField(name, T.StringType(), True) for name in wide_types()])


# JSON documents. Every leaf is text, as the public racing API sends it.
_DOCUMENTS = {
    "drivers": (
        "MRData STRUCT<DriverTable: STRUCT<Drivers: ARRAY<STRUCT<driverId: STRING,"
        " permanentNumber: STRING, code: STRING, url: STRING, givenName: STRING,"
        " familyName: STRING, dateOfBirth: STRING, nationality: STRING>>>>"
    ),
    "circuits": (
        "MRData STRUCT<CircuitTable: STRUCT<Circuits: ARRAY<STRUCT<circuitId: STRING,"
        " circuitName: STRING, url: STRING, Location: STRUCT<lat: STRING, long: STRING,"
        " locality: STRING, country: STRING>>>>>"
    ),
    "constructors": (
        "MRData STRUCT<ConstructorTable: STRUCT<Constructors: ARRAY<STRUCT<constructorId: STRING,"
        " url: STRING, name: STRING, nationality: STRING>>>>"
    ),
    "races": (
        "MRData STRUCT<total: STRING, RaceTable: STRUCT<Races: ARRAY<STRUCT<season: STRING,"
        " round: STRING, raceName: STRING, url: STRING, date: STRING, time: STRING,"
        " Circuit: STRUCT<circuitId: STRING>,"
        " FirstPractice: STRUCT<date: STRING, time: STRING>,"
        " SecondPractice: STRUCT<date: STRING, time: STRING>,"
        " ThirdPractice: STRUCT<date: STRING, time: STRING>>>>>"
    ),
    "results": (
        "MRData STRUCT<RaceTable: STRUCT<Races: ARRAY<STRUCT<season: STRING, round: STRING,"
        " date: STRING, Results: ARRAY<STRUCT<position: STRING, points: STRING, grid: STRING,"
        " laps: STRING, status: STRING, Driver: STRUCT<driverId: STRING>,"
        " Constructor: STRUCT<constructorId: STRING>, Time: STRUCT<time: STRING>,"
        " FastestLap: STRUCT<lap: STRING, Time: STRUCT<time: STRING>,"
        " AverageSpeed: STRUCT<speed: STRING>>>>>>>>"
    ),
    "laps": (
        "MRData STRUCT<total: STRING, RaceTable: STRUCT<Races: ARRAY<STRUCT<date: STRING,"
        " Laps: ARRAY<STRUCT<number: STRING, Timings: ARRAY<STRUCT<driverId: STRING,"
        " position: STRING, time: STRING>>>>>>>>"
    ),
    "pit_stops": (
        "MRData STRUCT<RaceTable: STRUCT<Races: ARRAY<STRUCT<season: STRING, round: STRING,"
        " PitStops: ARRAY<STRUCT<driverId: STRING, stop: STRING, lap: STRING, time: STRING,"
        " duration: STRING>>>>>>"
    ),
    "status": (
        "MRData STRUCT<StatusTable: STRUCT<Status: ARRAY<STRUCT<statusId: STRING,"
        " status: STRING>>>>"
    ),
    "driver_standings": (
        "MRData STRUCT<StandingsTable: STRUCT<StandingsLists: ARRAY<STRUCT<DriverStandings:"
        " ARRAY<STRUCT<position: STRING, points: STRING, wins: STRING,"
        " Driver: STRUCT<driverId: STRING>>>>>>>"
    ),
    "constructor_standings": (
        "MRData STRUCT<StandingsTable: STRUCT<StandingsLists: ARRAY<STRUCT<ConstructorStandings:"
        " ARRAY<STRUCT<position: STRING, points: STRING, wins: STRING,"
        " Constructor: STRUCT<constructorId: STRING>>>>>>>"
    ),
}

# Flat topic records.
_RECORDS = {
    "pit_stop": (
        "season STRING, round STRING, driverId STRING, stop INT, lap_pitstops INT,"
        " time_pitstops STRING, duration DOUBLE"
    ),
    "status": "statusId INT, status STRING",
    "result": (
        "round STRING, date STRING, constructorId STRING, driverId STRING, statusId STRING,"
        " positionOrder STRING, points DOUBLE, laps INT, grid INT, fastestLapTime STRING,"
        " fastestLapSpeed DOUBLE, time STRING, fastestLap INT"
    ),
}


def document_schema(kind: str) -> str:
    return _DOCUMENTS[kind]


def record_schema(kind: str) -> str:
    return _RECORDS[kind]
