"""Star roles over the TPC-H-like test tables.

Every role is a projection of whole test tables; the only joins are the small geography lookups and
lineitem with its order. ``sql.py`` writes the same roles for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DROPPED_COLUMNS, ORDER_COLUMN, TABLES, wide_types
from ..session import scratch_dir, stage
from ..sources.csv import select_apart

# The columns of the test tables that the roles are drawn from.
_INPUTS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
        " o_orderdate TIMESTAMP_NTZ"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
        " l_quantity DOUBLE, l_extendedprice DOUBLE"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT",
}

# Day number of the order date: the race of an order.
_DAY = "CAST(o_orderdate AS DATE)"
_RACE = f"CAST(datediff({_DAY}, DATE '1995-01-01') + 1 AS BIGINT)"

# SQL text of columns over an order. Points by finishing place.
_PRICE = "floor(o_totalprice)"
_PLACE = "CAST((o_orderkey * 7 + o_custkey * 3) % 12 + 1 AS INT)"
_POINTS = f"coalesce(try_element_at(array(25, 18, 15, 12, 10, 8, 6, 4, 2, 1), {_PLACE}), 0)"
_STATUS = "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END"
_STATUS_TEXT = (
    "CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN '+1 Lap' ELSE 'Collision' END"
)
_RESULT = {
    "resultId": "o_orderkey",
    "raceId": "race_no",
    "constructorId": "o_custkey % 10",
    "driverId": "o_custkey",
    "constructorStandingsId": "o_orderkey",
    "driverStandingsId": "o_orderkey",
    "statusId": _STATUS,
    "positionOrder": _PLACE,
    "points": _POINTS,
    "laps": f"{_PRICE} % 70",
    "grid": "o_orderkey % 20 + 1",
    "fastestLapTime": (
        f"if(o_orderstatus = 'P', NULL, concat('1:', lpad({_PRICE} % 60, 2, '0'), '.',"
        " lpad(o_orderkey % 1000, 3, '0')))"
    ),
    "fastestLapSpeed": f"if(o_orderstatus = 'P', NULL, 150 + {_PRICE} % 100)",
    "time": f"if({_PLACE} <= 10, concat('+', {_PLACE}, '.075'), NULL)",
    "fastestLap": "if(o_orderstatus = 'P', NULL, o_orderkey % 50 + 1)",
}
_DRIVER_STANDING = {
    "driverStandingsId": "o_orderkey",
    "driverId": "o_custkey",
    "position_driverstandings": "o_orderkey % 20 + 1",
    "points_driverstandings": f"{_PRICE} % 400",
    "wins": "if(o_orderkey % 31 = 0, NULL, o_orderkey % 13)",
}
_TEAM_STANDING = {
    "constructorStandingsId": "o_orderkey",
    "constructorId": "o_custkey % 10",
    "position_constructorstandings": "o_orderkey % 10 + 1",
    "wins_constructorstandings": "if(o_orderkey % 3001 = 5, NULL, o_orderkey % 17)",
    "points_constructorstandings": f"{_PRICE} % 400",
}

# SQL text of columns over a customer and its nation. One id in 89 shares its names with the id
# before it, one in 97 has no reference.
_OWNER = "(c_custkey - if(c_custkey % 89 = 7, 1, 0))"
_DRIVER = {
    "driverId": "c_custkey",
    "driverRef": f"if({_OWNER} % 97 = 50, NULL, concat('driver_', {_OWNER}))",
    "forename": f"concat('Forename ', {_OWNER} % 13)",
    "surname": f"concat('Surname ', {_OWNER})",
    "dob": "date_add(DATE '1970-01-01', CAST(c_custkey % 10000 AS INT))",
    "nationality": "n_name",
    "code": "upper(substr(c_mktsegment, 1, 3))",
    "number": "c_custkey % 100",
    "url": "concat('http://drivers.test/', c_custkey)",
}

# SQL text of columns over an order line.
PIT_CLOCK = (
    "concat('1', l_suppkey % 10, ':', lpad(l_partkey % 60, 2, '0'), ':',"
    " lpad(l_orderkey % 60, 2, '0'))"
)
_LAP_REST = "floor(l_extendedprice) % 60000"
LAP_TEXT = (
    f"concat('1:', lpad({_LAP_REST} DIV 1000, 2, '0'), '.', lpad({_LAP_REST} % 1000, 3, '0'))"
)
_STOP = {
    "stop": "l_linenumber",
    "lap_pitstops": "l_partkey % 50 + 1",
    "time_pitstops": PIT_CLOCK,
    "duration": "if(l_linenumber = 7, NULL, l_quantity)",
}
_LAP = {
    "lap": "l_linenumber",
    "time_laptimes": LAP_TEXT,
    "milliseconds_laptimes": f"CAST({_LAP_REST} + 60000 AS DOUBLE)",
    "position_laptimes": "l_suppkey % 20 + 1",
}

# Order lines that one task has at most, about.
LINES_PER_TASK = 500_000


def _as(columns: Mapping[str, str]) -> list[str]:
    return [f"{text} AS `{name}`" for name, text in columns.items()]


def _cast(table: str, columns: Mapping[str, str]) -> dict[str, str]:
    """The SQL text of every column of a star table, cast to its fixed type."""
    return {
        f.name: f"CAST({columns.get(f.name, f'`{f.name}`')} AS {f.dataType.simpleString()})"
        for f in TABLES[table]
    }


def _typed(df: DataFrame, table: str, columns: Mapping[str, str]) -> DataFrame:
    """The columns of a star table, by the SQL text of each, in their fixed types."""
    return df.selectExpr(*_as(_cast(table, columns)))


class Roles(Mapping[str, DataFrame]):
    """The thirteen star tables, each built when it is asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._built: dict[str, DataFrame] = {}
        self._builders: dict[str, Callable[[], DataFrame]] = {
            "driverDim": self._drivers,
            "constructorDim": self._constructors,
            "circuitDim": self._circuits,
            "raceDim": self._races,
            "raceStatusDim": self._statuses,
            "driverStandingsDim": self._driver_standings,
            "constructorStandingsDim": self._constructor_standings,
            "pitStopsDim": self._pit_stops,
            "lapsDim": self._laps,
            "qualificationsDim": self._qualifying,
            "freePracticeDim": self._practice,
            "sprintDim": self._sprints,
            "raceResultsFact": self._results,
        }

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self._built:
            self._built[table] = self._builders[table]()
        return self._built[table]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(_INPUTS[name]).parquet(f"{self.folder}/{name}.parquet")

    def orders(self) -> DataFrame:
        return self.read("orders").selectExpr("*", f"{_DAY} AS day", f"{_RACE} AS race_no")

    def tasks(self, least: int) -> int:
        """How many tasks all order lines are dealt to; the row count is read off the file's foot."""
        return max(least, self.read("lineitem").count() // LINES_PER_TASK + 1)

    def lines(self) -> DataFrame:
        """Every order line with its order."""
        return self.read("lineitem").join(self.orders(), F.expr("l_orderkey = o_orderkey"))

    def _drivers(self) -> DataFrame:
        customers = self.read("customer").join(
            self.read("nation"), F.expr("c_nationkey = n_nationkey")
        )
        return _typed(customers, "driverDim", _DRIVER)

    def _constructors(self) -> DataFrame:
        columns = {
            "constructorId": "s_suppkey",
            "constructorRef": "lower(replace(s_name, '#', '_'))",
            "name": "s_name",
            "nationality_constructors": "n_name",
            "url_constructors": "concat('http://teams.test/', s_suppkey)",
        }
        suppliers = self.read("supplier").join(
            self.read("nation"), F.expr("s_nationkey = n_nationkey")
        )
        return _typed(suppliers, "constructorDim", columns)

    def _circuits(self) -> DataFrame:
        columns = {
            "circuitId": "n_nationkey",
            "name_y": "n_name",
            "circuitRef": "lower(replace(n_name, ' ', '_'))",
            "location": "n_name",
            "country": "r_name",
            "lat": "n_nationkey * 1.5D",
            "lng": "100 - n_nationkey * 2.5D",
            "alt": "if(n_nationkey % 5 = 0, NULL, n_nationkey * 10)",
            "url_y": "concat('http://circuits.test/', n_nationkey)",
        }
        nations = self.read("nation").join(self.read("region"), F.expr("n_regionkey = r_regionkey"))
        return self._staged("circuits", lambda: _typed(nations, "circuitDim", columns))

    def _races(self) -> DataFrame:
        """One race per order date."""

        def calendar() -> DataFrame:
            columns = {
                "raceId": "race_no",
                "circuitId": "race_no % 25",
                "name_x": "concat('Race ', race_no)",
                "date": "day",
                "year": "year(day)",
                "round": "dayofyear(day)",
                "time_races": "concat(lpad(race_no % 24, 2, '0'), ':00:00')",
                "url_x": "concat('http://races.test/', race_no)",
            }
            days = self.orders().select("day", "race_no").distinct()
            return _typed(days, "raceDim", columns)

        return self._staged("races", calendar)

    def _staged(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A small table, staged once per session.

        It is tiny next to the orders it is drawn from; as a table its size is known, so Spark can
        tell that a join with it needs no shuffle. Shuffled by such a key, the orders would land in
        as many tasks as it has values.
        """
        key = (scratch_dir(self.spark), self.folder, name)
        if key not in _STAGED:
            _STAGED[key] = stage(build(), name)
        return _STAGED[key]

    def _statuses(self) -> DataFrame:
        def statuses() -> DataFrame:
            columns = {"statusId": _STATUS, "status": _STATUS_TEXT}
            found = self.read("orders").select("o_orderstatus").distinct()
            return _typed(found, "raceStatusDim", columns)

        return self._staged("statuses", statuses)

    def teams_of_orders(self) -> DataFrame:
        """The teams that orders name: few, however many there are."""

        def teams() -> DataFrame:
            named = self.read("orders").selectExpr(f"{_RESULT['constructorId']} AS constructorId")
            return self["constructorDim"].join(named.distinct(), "constructorId", "left_semi")

        return self._staged("teams", teams)

    def _results(self) -> DataFrame:
        return _typed(self.orders(), "raceResultsFact", _RESULT)

    def _driver_standings(self) -> DataFrame:
        return _typed(self.read("orders"), "driverStandingsDim", _DRIVER_STANDING)

    def _constructor_standings(self) -> DataFrame:
        return _typed(self.read("orders"), "constructorStandingsDim", _TEAM_STANDING)

    def _pit_stops(self) -> DataFrame:
        ids = {"raceId": "race_no", "driverId": "o_custkey"}
        return _typed(self.lines(), "pitStopsDim", {**ids, **_STOP})

    def _laps(self) -> DataFrame:
        ids = {"raceId": "race_no", "driverId": "o_custkey"}
        return _typed(self.lines(), "lapsDim", {**ids, **_LAP})

    def _qualifying(self) -> DataFrame:
        columns = {
            "raceId": "dayofyear(ts)",
            "driverId": "user_id",
            "quali_time": "if(event_id % 7 = 0, NULL, concat(lpad(hour(ts), 2, '0'), ':00:00'))",
            "quali_date": "CAST(ts AS DATE)",
        }
        return _typed(self.read("events"), "qualificationsDim", columns)

    def _practice(self) -> DataFrame:
        clock = "concat(lpad(raceId % 24, 2, '0'), ':30:00')"
        columns = {
            "fp1_date": "date_sub(date, 2)",
            "fp2_date": "if(raceId % 5 = 0, NULL, date_sub(date, 1))",
            "fp3_date": "if(raceId % 5 = 0, NULL, date_sub(date, 1))",
            "fp1_time": clock,
            "fp2_time": f"if(raceId % 5 = 0, NULL, {clock})",
            "fp3_time": f"if(raceId % 5 = 0, NULL, {clock})",
        }
        return _typed(self._races(), "freePracticeDim", columns)

    def _sprints(self) -> DataFrame:
        columns = {
            "raceId": "race_no",
            "driverId": "o_custkey",
            "sprint_date": "if(race_no % 5 = 0, date_sub(day, 1), NULL)",
            "sprint_time": "if(race_no % 5 = 0, '11:00:00', NULL)",
        }
        return _typed(self.orders(), "sprintDim", columns)

    # -- the wide file ------------------------------------------------------------------------

    def wide_text(self) -> DataFrame:
        """The denormalised file: one row per order line, every value as text, ``\\N`` for null.

        Surname and circuit location change from row to row of one id, so that keeping the first
        row matters; a few numbers are unreadable on purpose.
        """
        columns = {
            "l_orderkey": "o_orderkey",
            **_DRIVER_STANDING,
            **_TEAM_STANDING,
            **_RESULT,
            **{
                {"number": "number_driver"}.get(name, name): text
                for name, text in _cast("driverDim", _DRIVER).items()
            },
        }
        # the given file is one row group, hence one task; what follows is the work of many. Only the
        # given columns are shuffled; behind the shuffle an order's texts are made once for its lines
        tasks = self.tasks(int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        customers = self.read("customer").drop("c_name")
        orders = (
            self.orders()
            .join(customers, F.expr("o_custkey = c_custkey"))
            .repartition(tasks, "o_orderkey")
            .join(self.read("nation"), F.expr("c_nationkey = n_nationkey"))
            .selectExpr("o_orderkey", *_as(columns))
            .join(self["raceDim"], "raceId")
            .join(self["freePracticeDim"], "raceId")
            .join(self["circuitDim"], "circuitId")
            .join(self["raceStatusDim"], "statusId")
            .join(self.teams_of_orders(), "constructorId")
        )
        changed = {
            "surname": "concat(surname, if(l_orderkey % 3 = 0, ' jr', ''))",
            "location": "concat(location, ' ', l_orderkey % 4)",
            "number": "number_driver",
            "alt": "CASE circuitId % 5 WHEN 1 THEN 'abc' WHEN 2 THEN '1d' ELSE string(alt) END",
            "sprint_date": "if(raceId % 5 = 0, date_sub(date, 1), NULL)",
            "sprint_time": "if(raceId % 5 = 0, '11:00:00', NULL)",
            "quali_date": "if(raceId % 5 = 0, NULL, date_sub(date, 1))",
            "quali_time": "if(raceId % 5 = 0, NULL, concat(lpad(raceId % 24, 2, '0'), ':45:00'))",
            "position": "if(positionOrder <= 10, positionOrder, NULL)",
            **{c: "'x'" for c in DROPPED_COLUMNS},
        }
        by_line = {
            **{c: f"`{c}`" for c in (*_STOP, *_LAP)},
            ORDER_COLUMN: "o_orderkey * 10 + lap",
            "duration": "if(stop = 6, '1:02.3', string(duration))",
            "milliseconds": "if(positionOrder <= 10, milliseconds_laptimes, NULL)",
        }

        def text(column: str) -> str:
            return f"coalesce(string({column}), '\\\\N')"

        told = [c for c in wide_types() if c not in by_line]
        texts = ", ".join(f"{text(changed.get(c, f'`{c}`'))} AS `{c}`" for c in told)
        # one column on its way through the join
        columns = ("o_orderkey", f"struct({texts})", "positionOrder")
        orders = select_apart(orders, dict(zip(("o_orderkey", "_order", "positionOrder"), columns)))
        lines = self.read("lineitem").repartition(tasks, "l_orderkey")
        rows = orders.join(lines, F.expr("o_orderkey = l_orderkey")).selectExpr(
            "o_orderkey", "positionOrder", "_order", *_as({**_STOP, **_LAP})
        )
        return select_apart(
            rows, {c: text(by_line[c]) if c in by_line else f"_order.`{c}`" for c in wide_types()}
        )


_STAGED: dict[tuple[str, str, str], DataFrame] = {}
