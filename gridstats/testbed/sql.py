"""The roles of ``roles.py`` as DuckDB SQL, and one statement per comparable query."""

from __future__ import annotations

ROLES = """
WITH ord AS (
  SELECT o.*, CAST(o_orderdate AS DATE) AS day,
         CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 1 AS BIGINT) AS race_no,
         CAST(floor(o_totalprice) AS BIGINT) AS price,
         CAST((o_orderkey * 7 + o_custkey * 3) % 12 + 1 AS INTEGER) AS place
  FROM orders o),
driver AS (
  SELECT c_custkey AS driverId,
         CASE WHEN owner % 97 <> 50 THEN 'driver_' || owner END AS driverRef,
         'Forename ' || (owner % 13) AS forename, 'Surname ' || owner AS surname,
         CAST(DATE '1970-01-01' + CAST(c_custkey % 10000 AS INTEGER) AS DATE) AS dob,
         n_name AS nationality, upper(substr(c_mktsegment, 1, 3)) AS code,
         CAST(c_custkey % 100 AS INTEGER) AS number, 'http://drivers.test/' || c_custkey AS url
  FROM (SELECT *, c_custkey - CASE WHEN c_custkey % 89 = 7 THEN 1 ELSE 0 END AS owner FROM customer)
  JOIN nation ON c_nationkey = n_nationkey),
team AS (
  SELECT s_suppkey AS constructorId, lower(replace(s_name, '#', '_')) AS constructorRef,
         s_name AS name, n_name AS nationality_constructors,
         'http://teams.test/' || s_suppkey AS url_constructors
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
circuit AS (
  SELECT CAST(n_nationkey AS BIGINT) AS circuitId, n_name AS name_y,
         lower(replace(n_name, ' ', '_')) AS circuitRef, n_name AS location, r_name AS country,
         CAST(n_nationkey * 1.5 AS DOUBLE) AS lat, CAST(100 - n_nationkey * 2.5 AS DOUBLE) AS lng,
         CASE WHEN n_nationkey % 5 <> 0 THEN CAST(n_nationkey * 10 AS DOUBLE) END AS alt,
         'http://circuits.test/' || n_nationkey AS url_y
  FROM nation JOIN region ON n_regionkey = r_regionkey),
race AS (
  SELECT race_no AS raceId, race_no % 25 AS circuitId, 'Race ' || race_no AS name_x, day AS date,
         CAST(year(day) AS INTEGER) AS year, CAST(dayofyear(day) AS INTEGER) AS round,
         lpad(CAST(race_no % 24 AS VARCHAR), 2, '0') || ':00:00' AS time_races,
         'http://races.test/' || race_no AS url_x
  FROM (SELECT DISTINCT day, race_no FROM ord)),
status AS (
  SELECT DISTINCT CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT) AS statusId,
         CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN '+1 Lap' ELSE 'Collision' END AS status
  FROM ord),
result AS (
  SELECT o_orderkey AS resultId, race_no AS raceId, o_custkey % 10 AS constructorId,
         o_custkey AS driverId, o_orderkey AS constructorStandingsId, o_orderkey AS driverStandingsId,
         CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT) AS statusId,
         place AS positionOrder,
         CAST(CASE place WHEN 1 THEN 25 WHEN 2 THEN 18 WHEN 3 THEN 15 WHEN 4 THEN 12 WHEN 5 THEN 10
              WHEN 6 THEN 8 WHEN 7 THEN 6 WHEN 8 THEN 4 WHEN 9 THEN 2 WHEN 10 THEN 1 ELSE 0 END AS DOUBLE) AS points,
         CAST(price % 70 AS INTEGER) AS laps, CAST(o_orderkey % 20 + 1 AS INTEGER) AS grid,
         CASE WHEN o_orderstatus <> 'P' THEN '1:' || lpad(CAST(price % 60 AS VARCHAR), 2, '0') || '.'
              || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0') END AS fastestLapTime,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(150 + price % 100 AS DOUBLE) END AS fastestLapSpeed,
         CASE WHEN place <= 10 THEN '+' || place || '.075' END AS time,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 50 + 1 AS INTEGER) END AS fastestLap
  FROM ord),
driver_standing AS (
  SELECT o_orderkey AS driverStandingsId, o_custkey AS driverId,
         CAST(o_orderkey % 20 + 1 AS INTEGER) AS position_driverstandings,
         CAST(price % 400 AS DOUBLE) AS points_driverstandings,
         CASE WHEN o_orderkey % 31 <> 0 THEN CAST(o_orderkey % 13 AS INTEGER) END AS wins
  FROM ord),
team_standing AS (
  SELECT o_orderkey AS constructorStandingsId, o_custkey % 10 AS constructorId,
         CAST(o_orderkey % 10 + 1 AS INTEGER) AS position_constructorstandings,
         CASE WHEN o_orderkey % 3001 <> 5 THEN CAST(o_orderkey % 17 AS INTEGER) END AS wins_constructorstandings,
         CAST(price % 400 AS DOUBLE) AS points_constructorstandings
  FROM ord),
line AS (
  SELECT *, CAST(60000 + CAST(floor(l_extendedprice) AS BIGINT) % 60000 AS BIGINT) AS lap_ms
  FROM lineitem JOIN ord ON l_orderkey = o_orderkey),
pit AS (
  SELECT race_no AS raceId, o_custkey AS driverId, l_linenumber AS stop,
         CAST(l_partkey % 50 + 1 AS INTEGER) AS lap_pitstops,
         '1' || (l_suppkey % 10) || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') || ':'
             || lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0') AS time_pitstops,
         CASE WHEN l_linenumber <> 7 THEN l_quantity END AS duration,
         l_orderkey, l_partkey, l_suppkey, l_extendedprice
  FROM line),
lap AS (
  SELECT race_no AS raceId, o_custkey AS driverId, l_linenumber AS lap,
         '1:' || lpad(CAST((lap_ms - 60000) // 1000 AS VARCHAR), 2, '0') || '.'
              || lpad(CAST(lap_ms % 1000 AS VARCHAR), 3, '0') AS time_laptimes,
         CAST(lap_ms AS DOUBLE) AS milliseconds_laptimes,
         CAST(l_suppkey % 20 + 1 AS INTEGER) AS position_laptimes,
         l_orderkey, l_partkey, l_suppkey, l_extendedprice
  FROM line),
qualifying AS (
  SELECT CAST(dayofyear(CAST(ts AS DATE)) AS BIGINT) AS raceId, user_id AS driverId,
         CASE WHEN event_id % 7 <> 0 THEN lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || ':00:00' END AS quali_time,
         CAST(ts AS DATE) AS quali_date,
         CASE WHEN event_id % 7 <> 0 THEN CAST(hour(ts) * 3600 AS DOUBLE) END AS seconds
  FROM events),
practice AS (
  SELECT raceId, CAST(date - 2 AS DATE) AS fp1_date,
         CASE WHEN raceId % 5 <> 0 THEN CAST(date - 1 AS DATE) END AS fp2_date,
         CASE WHEN raceId % 5 <> 0 THEN CAST(date - 1 AS DATE) END AS fp3_date,
         lpad(CAST(raceId % 24 AS VARCHAR), 2, '0') || ':30:00' AS fp1_time,
         CASE WHEN raceId % 5 <> 0 THEN lpad(CAST(raceId % 24 AS VARCHAR), 2, '0') || ':30:00' END AS fp2_time,
         CASE WHEN raceId % 5 <> 0 THEN lpad(CAST(raceId % 24 AS VARCHAR), 2, '0') || ':30:00' END AS fp3_time
  FROM race),
sprint AS (
  SELECT race_no AS raceId, o_custkey AS driverId,
         CASE WHEN race_no % 5 = 0 THEN CAST(day - 1 AS DATE) END AS sprint_date,
         CASE WHEN race_no % 5 = 0 THEN '11:00:00' END AS sprint_time
  FROM ord)
"""

_D = "driverRef AS driver_reference, forename AS driver_forename, surname AS driver_surname"
_C = "constructorRef AS constructor_reference, name AS constructor_name"
_WINS = "CAST(sum(CASE WHEN positionOrder = 1 THEN 1 ELSE 0 END) AS BIGINT)"
_PODIUMS = "CAST(sum(CASE WHEN positionOrder <= 3 THEN 1 ELSE 0 END) AS BIGINT)"


def _season_body(names: str, groups: str, dim: str, key: str, measures: str, where: str = "") -> str:
    return (
        f"SELECT {names}, year AS season_year, {measures} FROM {dim} JOIN result USING ({key})"
        f" JOIN race USING (raceId) {where} GROUP BY {groups}, year"
    )


def _driver_season(measures: str, where: str = "") -> str:
    return _season_body(_D, "driverRef, forename, surname", "driver", "driverId", measures, where)


def _team_season(measures: str) -> str:
    return _season_body(_C, "constructorRef, name", "team", "constructorId", measures)


_AVG = "avg(positionOrder) AS avg_finish_position"
_POINTS = "sum(points) AS total_points"
_COUNT = "count(resultId) AS races_count"
_TRENDS = f"{_AVG}, {_POINTS}, {_COUNT}, {_WINS} AS wins, {_PODIUMS} AS podiums"
_SHORT = f"{_POINTS}, {_WINS} AS wins, {_AVG}"


def _record(measure: str, label: str, where: str = "") -> str:
    body = _driver_season(f"{measure} AS {label}", where)
    return (
        f"{body} ORDER BY {label} DESC NULLS FIRST, driver_reference NULLS LAST, season_year,"
        " driver_forename, driver_surname LIMIT 1"
    )


def _runs(dim: str, key: str, reference: str, extra: str) -> str:
    """Lengths of unbroken podium (3) and winning (1) runs, both flags in one pass.

    Results that break a run are counted along a history; the count names the run.
    """
    names = f"{reference}, {extra}"
    return f"""flagged AS (
  SELECT {names}, date, resultId, best,
         coalesce(CASE best WHEN 1 THEN positionOrder = 1 ELSE positionOrder <= 3 END, FALSE) AS good
  FROM {dim} JOIN result USING ({key}) JOIN race USING (raceId), (VALUES (1), (3)) AS flags(best)),
numbered AS (
  SELECT {names}, best, good, sum(CASE WHEN good THEN 0 ELSE 1 END) OVER (
         PARTITION BY {reference}, best ORDER BY date, resultId
         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS breaks FROM flagged),
lengths AS (SELECT {names}, best, count(*) AS n FROM numbered WHERE good GROUP BY {names}, best, breaks)"""


def _streaks(dim: str, key: str, reference: str, extra: str, labels: str) -> str:
    """One row per entity with a podium; a winning run needs all names, as equal names match it."""
    names = f"{reference}, {extra}"
    named = " AND ".join(f"{n.strip()} IS NOT NULL" for n in names.split(","))
    return f"""{_runs(dim, key, reference, extra)}
SELECT {labels}, max(n) FILTER (WHERE best = 3) AS longest_podium_streak,
       CASE WHEN {named} THEN coalesce(max(n) FILTER (WHERE best = 1), 0) ELSE 0 END
         AS longest_winning_streak
FROM lengths GROUP BY {names} HAVING bool_or(best = 3)"""


def view_statements(driver: str, driver_year: int, team_year: int) -> dict[str, str]:
    def wins(names: str, dim: str, key: str, standing: str, standing_id: str, column: str, year: int, out: str) -> str:
        ref = names.split(",")[0]
        return f"""SELECT {out}, best AS wins_in_year FROM (
  SELECT {names}, {column} AS best, row_number() OVER (PARTITION BY {ref}
         ORDER BY {column} DESC NULLS FIRST, s.{standing_id}, d.{key}) AS rn
  FROM {dim} d JOIN {standing} s ON d.{key} = s.{key}
  JOIN result r ON s.{standing_id} = r.{standing_id} JOIN race USING (raceId)
  WHERE date >= DATE '{year}-01-01' AND date < DATE '{year + 1}-01-01') WHERE rn = 1"""

    career = (
        f"SELECT {_D}, {_AVG}, {_POINTS}, {_WINS} AS wins_count FROM driver JOIN result USING (driverId)"
        " WHERE driverRef {op} '" + driver + "' GROUP BY driverRef, forename, surname"
    )
    other = f"WHERE driverRef <> '{driver}'"
    plain = {
        "driver_wins_in_year": wins(
            "driverRef, forename, surname, dob, nationality, code", "driver", "driverId",
            "driver_standing", "driverStandingsId", "wins", driver_year,
            f"{_D}, dob AS driver_dob, nationality AS driver_nationality, code AS driver_code",
        ),
        "constructor_wins_in_year": wins(
            "constructorRef, name, nationality_constructors", "team", "constructorId",
            "team_standing", "constructorStandingsId", "wins_constructorstandings", team_year,
            f"{_C}, nationality_constructors AS constructor_nationality",
        ),
        "driver_by_circuit": f"""SELECT {_D}, circuitId AS circuit_id, name_y AS circuit_name,
  country AS circuit_country, {_AVG}, {_COUNT}, {_POINTS},
  max(positionOrder) AS best_finish_position, min(positionOrder) AS worst_finish_position
FROM driver JOIN result USING (driverId) JOIN race USING (raceId) JOIN circuit USING (circuitId)
GROUP BY driverRef, forename, surname, circuitId, name_y, country""",
        "constructor_over_seasons": _team_season(
            f"{_POINTS}, {_COUNT}, count(DISTINCT raceId) AS races_entered, {_WINS} AS wins, {_PODIUMS} AS podiums"
        ),
        "driver_trends": _driver_season(_TRENDS),
        "driver_season_comparison": _driver_season(_TRENDS),
        "constructor_season_comparison": _team_season(_TRENDS),
        "driver_season_performance": _driver_season(_SHORT),
        "constructor_season_performance": _team_season(_SHORT),
        "circuit_records": f"""SELECT name_y AS circuit_name, year AS season_year, {_D},
  fastestLapTime AS fastest_lap_time, fastestLapSpeed AS fastest_lap_speed
FROM result JOIN race USING (raceId) JOIN circuit USING (circuitId) JOIN driver USING (driverId)
WHERE fastestLapTime IS NOT NULL""",
        "circuit_record_holders": f"""SELECT circuit_name, season_year, {_D}, fastest_lap_time, fastest_lap_speed
FROM (SELECT name_y AS circuit_name, year AS season_year, driverId, fastestLapTime AS fastest_lap_time,
        fastestLapSpeed AS fastest_lap_speed,
        row_number() OVER (PARTITION BY circuitId ORDER BY fastestLapTime, resultId) AS rn
      FROM result JOIN race USING (raceId) JOIN circuit USING (circuitId)
      WHERE fastestLapTime IS NOT NULL) JOIN driver USING (driverId) WHERE rn = 1""",
        "pit_stop_effectiveness": f"""SELECT year AS season_year, t.name AS constructor_name, {_D},
  positionOrder AS finish_position, count(stop) AS pit_stops_count,
  avg(duration) AS avg_pit_stop_duration
FROM pit p JOIN result r ON p.raceId = r.raceId AND p.driverId = r.driverId
JOIN driver d ON p.driverId = d.driverId JOIN team t ON r.constructorId = t.constructorId
JOIN race ra ON r.raceId = ra.raceId
GROUP BY year, t.name, driverRef, forename, surname, positionOrder""",
        "driver_qualifying": f"""SELECT {_D}, avg(seconds) AS avg_qualifying_seconds,
  count(CASE WHEN seconds = 0 THEN 1 END) AS pole_positions
FROM driver JOIN qualifying USING (driverId) GROUP BY driverRef, forename, surname""",
        "career_excluding": career.format(op="<>"),
        "career_only": career.format(op="="),
        "most_wins_season": _record(_WINS, "wins_count"),
        "most_wins_season_excl": _record(_WINS, "wins_count", other),
        "most_podiums_season": _record(_PODIUMS, "podiums_count"),
        "most_podiums_season_excl": _record(_PODIUMS, "podiums_count", other),
        "most_points_season": _record("sum(points)", "total_points"),
        "most_points_season_excl": _record("sum(points)", "total_points", other),
        "most_wins_in_row": f"""SELECT {_D}, count(*) AS wins_in_a_row
FROM driver JOIN result USING (driverId) JOIN race USING (raceId) WHERE positionOrder = 1
GROUP BY driverRef, forename, surname
ORDER BY wins_in_a_row DESC, driver_reference NULLS LAST, driver_forename, driver_surname LIMIT 1""",
    }
    drivers = _streaks(
        "driver", "driverId", "driverRef", "forename, surname",
        _D,
    )
    teams = _streaks(
        "team", "constructorId", "constructorRef", "name",
        _C,
    )
    statements = {k: f"{ROLES}{v}" for k, v in plain.items()}
    statements["driver_streaks"] = f"{ROLES.rstrip()}, {drivers}"
    statements["constructor_streaks"] = f"{ROLES.rstrip()}, {teams}"
    statements["most_wins_in_row_true"] = (
        f"{ROLES.rstrip()}, {_runs('driver', 'driverId', 'driverRef', 'forename, surname')}"
        f" SELECT {_D}, max(n) AS wins_in_a_row FROM lengths WHERE best = 1"
        " GROUP BY driverRef, forename, surname"
        " ORDER BY wins_in_a_row DESC, driverRef NULLS LAST, forename, surname LIMIT 1"
    )
    return statements


# -- sources, cleaning and the star split -----------------------------------------------------

# The wide file, typed: one row per order line, with the drifting and unreadable values.
WIDE = f"""{ROLES.rstrip()},
wide AS (
  SELECT CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS _ord, l_orderkey,
         d.driverId, d.driverRef, d.forename,
         d.surname || CASE WHEN l_orderkey % 3 = 0 THEN ' jr' ELSE '' END AS surname,
         d.dob, d.nationality, d.code, d.number, d.url,
         t.constructorId, t.constructorRef, t.name, t.nationality_constructors, t.url_constructors,
         c.circuitId, c.name_y, c.circuitRef, c.location || ' ' || (l_orderkey % 4) AS location,
         c.country, c.lat, c.lng, CASE WHEN c.circuitId % 5 > 2 THEN c.alt END AS alt, c.url_y,
         s.statusId, s.status, ra.raceId, ra.name_x, ra.date, ra.year, ra.round, ra.time_races, ra.url_x,
         CASE WHEN ra.raceId % 5 = 0 THEN CAST(ra.date - 1 AS DATE) END AS sprint_date,
         CASE WHEN ra.raceId % 5 = 0 THEN '11:00:00' END AS sprint_time,
         CASE WHEN ra.raceId % 5 <> 0 THEN CAST(ra.date - 1 AS DATE) END AS quali_date,
         CASE WHEN ra.raceId % 5 <> 0 THEN lpad(CAST(ra.raceId % 24 AS VARCHAR), 2, '0') || ':45:00' END AS quali_time,
         p.fp1_date, p.fp2_date, p.fp3_date, p.fp1_time, p.fp2_time, p.fp3_time,
         r.driverStandingsId, ds.position_driverstandings, ds.points_driverstandings, ds.wins,
         r.constructorStandingsId, ts.position_constructorstandings, ts.wins_constructorstandings,
         ts.points_constructorstandings,
         l_linenumber AS stop, CAST(l_partkey % 50 + 1 AS INTEGER) AS lap_pitstops,
         '1' || (l_suppkey % 10) || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') || ':'
             || lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0') AS time_pitstops,
         CASE WHEN l_linenumber < 6 THEN l_quantity END AS duration,
         l_linenumber AS lap,
         '1:' || lpad(CAST((lap_ms - 60000) // 1000 AS VARCHAR), 2, '0') || '.'
              || lpad(CAST(lap_ms % 1000 AS VARCHAR), 3, '0') AS time_laptimes,
         CAST(lap_ms AS DOUBLE) AS milliseconds_laptimes,
         CAST(l_suppkey % 20 + 1 AS INTEGER) AS position_laptimes,
         r.resultId, r.positionOrder, r.points, r.laps, r.grid, r.fastestLapTime, r.fastestLapSpeed,
         r.time, r.fastestLap,
         CASE WHEN r.positionOrder <= 10 THEN CAST(r.positionOrder AS DOUBLE) END AS position,
         CASE WHEN r.positionOrder <= 10 THEN CAST(lap_ms AS DOUBLE) END AS milliseconds
  FROM line
  JOIN result r ON r.resultId = l_orderkey JOIN driver d ON d.driverId = r.driverId
  JOIN team t ON t.constructorId = r.constructorId JOIN status s ON s.statusId = r.statusId
  JOIN race ra ON ra.raceId = r.raceId JOIN circuit c ON c.circuitId = ra.circuitId
  JOIN practice p ON p.raceId = ra.raceId
  JOIN driver_standing ds ON ds.driverStandingsId = r.driverStandingsId
  JOIN team_standing ts ON ts.constructorStandingsId = r.constructorStandingsId)
"""


def source_statements() -> dict[str, str]:
    from ..schemas import DROPPED_COLUMNS, wide_types
    from .queries import DRIVER, SPLIT_RACE

    flat = (
        "CAST(round AS VARCHAR) AS round, CAST(date AS VARCHAR) AS date, constructorRef AS constructorId,"
        " driverRef AS driverId, status AS statusId, CAST(positionOrder AS VARCHAR) AS positionOrder,"
        " points, laps, grid, fastestLapTime,"
        " CASE WHEN positionOrder <> 12 THEN fastestLapSpeed END AS fastestLapSpeed, time, fastestLap"
    )
    results = f"""{ROLES}SELECT {flat} FROM result JOIN race USING (raceId) JOIN status USING (statusId)
JOIN team USING (constructorId) JOIN driver USING (driverId)"""
    numbers = (
        "position, CAST(fastestLap AS DOUBLE) AS fastestLap, fastestLapSpeed, alt, duration,"
        " milliseconds_laptimes, milliseconds, CAST(circuitId AS DOUBLE) AS circuitId,"
        " CAST(NULL AS DOUBLE) AS milliseconds_pitstops"
    )
    kept = [c for c in wide_types() if c not in DROPPED_COLUMNS]
    special = {
        **{c: "'x'" for c in DROPPED_COLUMNS},
        "duration": "CASE WHEN stop = 6 THEN '1:02.3' WHEN stop <> 7 THEN CAST(duration AS VARCHAR) END",
        "alt": (
            "CASE circuitId % 5 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN '1d'"
            " ELSE CAST(alt AS VARCHAR) END"
        ),
        **{
            c: f"CAST(CAST({c} AS BIGINT) AS VARCHAR)"
            for c in (
                "position", "points", "points_driverstandings", "points_constructorstandings", "fastestLapSpeed",
            )
        },
    }
    texts = ", ".join(f"{special.get(c, f'CAST({c} AS VARCHAR)')} AS {c}" for c in wide_types())
    last = list(wide_types())[-1]
    line = "concat_ws(',', " + ", ".join(f"coalesce({c}, '\\N')" for c in wide_types()) + ")"
    no_text = ", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in wide_types())
    rejects = f"""{WIDE.rstrip()},
written AS (SELECT {texts} FROM wide),
planted AS (
  SELECT *, CASE WHEN lap = '1' THEN 0 ELSE CAST(resultId AS BIGINT) % 7 END AS fault FROM written)
SELECT * EXCLUDE (fault) REPLACE (
    CASE WHEN lap = '1' THEN replace(surname, ' ', chr(10)) ELSE surname END AS surname,
    CASE WHEN fault <> 6 THEN {last} END AS {last}),
  CAST(NULL AS VARCHAR) AS first_field, CAST(NULL AS BIGINT) AS fields, CAST(NULL AS VARCHAR) AS line
FROM planted WHERE fault NOT IN (3, 5)
UNION ALL
SELECT {no_text}, _ord AS first_field, CAST({len(wide_types())} + CASE fault WHEN 3 THEN 1 ELSE 2 END AS BIGINT) AS fields,
  {line} || CASE fault WHEN 3 THEN ',more' ELSE ',,' END AS line
FROM planted WHERE fault IN (3, 5)"""
    trends = _driver_season(_TRENDS)
    career = (
        "SELECT driverRef, surname FROM driver JOIN result USING (driverId)"
        f" WHERE driverRef <> '{DRIVER}' GROUP BY driverRef, forename, surname HAVING {_WINS} > 0"
    )
    return {
        "scan_csv_clean": f"{WIDE}SELECT {', '.join(kept)} FROM wide",
        "scan_csv_rejects": rejects,
        "scan_json_docs": results,
        "scan_requests": results,
        "sink_json_records": results,
        "flatten_results": results,
        "load_append": f"{ROLES}SELECT * FROM result",
        "load_insert_ignore": (
            f"{ROLES}SELECT * REPLACE (CAST(CASE WHEN raceId <= {SPLIT_RACE} THEN grid ELSE 0 END AS INTEGER) AS grid)"
            " FROM result"
        ),
        "null_tokens": f"{WIDE}SELECT {texts} FROM wide",
        "coerce_numeric": f"{WIDE}SELECT CAST(_ord AS VARCHAR) AS _ord, {numbers} FROM wide",
        "drop_columns": f"{ROLES}SELECT * EXCLUDE (grid, laps, time) FROM result",
        "parse_date": (
            f"{WIDE}SELECT CAST(_ord AS VARCHAR) AS _ord, dob, date, quali_date, sprint_date FROM wide"
        ),
        "ms_to_interval": (
            f"{ROLES}SELECT raceId, driverId, lap, milliseconds_laptimes / 1000 AS lap_seconds FROM lap"
        ),
        "first_per_key": f"""{ROLES}SELECT driverId, raceId, resultId, positionOrder FROM (
  SELECT *, row_number() OVER (PARTITION BY driverId ORDER BY raceId, resultId) AS rn FROM result)
WHERE rn = 1""",
        "distinct_project": f"{ROLES}SELECT DISTINCT raceId, driverId, sprint_date FROM sprint",
        "register_views": f"""{ROLES.rstrip()},
trends AS ({trends}), career AS ({career})
SELECT t.season_year, count(*) AS driver_count, CAST(sum(t.podiums) AS BIGINT) AS podiums,
  sum(t.total_points) AS total_points
FROM trends t JOIN career c ON t.driver_reference = c.driverRef AND t.driver_surname = c.surname
GROUP BY t.season_year""",
    }


def _row_number(table: str) -> str:
    """A number from the digest of a row."""
    from ..schemas import TABLES

    texts = []
    for field in TABLES[table]:
        double = field.dataType.simpleString() == "double"
        value = f"CAST(floor({field.name} * 1000 + 0.5) AS BIGINT)" if double else field.name
        texts.append(f"coalesce(CAST({value} AS VARCHAR), '~')")
    return f"CAST('0x' || substr(md5({' || chr(124) || '.join(texts)}), 1, 8) AS BIGINT)"


def star_statements() -> dict[str, str]:
    from ..schemas import TABLES
    from .queries import STAR_KEYS

    firsts = {"driverDim": "driverId", "circuitDim": "circuitId", "raceStatusDim": "statusId", "raceDim": "raceId"}
    bodies = {}
    for key, table in STAR_KEYS.items():
        columns = ", ".join(f.name for f in TABLES[table])
        if table in firsts:
            bodies[key] = (
                f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {firsts[table]}"
                " ORDER BY _ord) AS rn FROM wide) WHERE rn = 1"
            )
        else:
            bodies[key] = f"SELECT DISTINCT {columns} FROM wide"
    statements = {key: f"{WIDE}{body}" for key, body in bodies.items()}
    statements["star_all_counts"] = WIDE + " UNION ALL ".join(
        f"SELECT '{STAR_KEYS[key]}' AS table_name, count(*) AS row_count,"
        f" CAST(sum({_row_number(STAR_KEYS[key])}) AS BIGINT) AS digest FROM ({body})"
        for key, body in bodies.items()
    )
    return statements


# -- documents --------------------------------------------------------------------------------


def document_statements() -> dict[str, str]:
    minute_text = "60 + l_quantity + 0.5"

    def pit(duration: str) -> str:
        return f"""{ROLES}SELECT CAST(year(day) AS VARCHAR) AS season, CAST(dayofyear(day) AS VARCHAR) AS round,
  driverRef AS driverId, l_linenumber AS stop, CAST(l_partkey % 50 + 1 AS INTEGER) AS lap_pitstops,
  '1' || (l_suppkey % 10) || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') || ':'
      || lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0') AS time_pitstops,
  CASE WHEN l_linenumber % 2 = 0 THEN {minute_text} ELSE {duration} END AS duration
FROM line JOIN driver ON o_custkey = driverId"""

    def standings(table: str, dim: str, key: str, ref: str, out: str, kind: str) -> str:
        return f"""{ROLES}SELECT {ref} AS {out}, position_{kind} AS position, points_{kind} AS points,
  coalesce({"wins" if kind == "driverstandings" else "wins_constructorstandings"}, 0) AS wins
FROM {table} s JOIN {dim} d ON s.{key} = d.{key}
WHERE (s.{out.removesuffix("Id")}StandingsId // 50) % 11 <> 10"""

    return {
        "doc_counts": """SELECT 'drivers' AS kind, count(DISTINCT c_custkey // 30) AS document_count, count(*) AS item_count FROM customer
UNION ALL SELECT 'circuits', count(DISTINCT n_nationkey // 10), count(*) FROM nation
UNION ALL SELECT 'constructors', count(DISTINCT s_suppkey // 30), count(*) FROM supplier""",
        "doc_race_results": "SELECT CAST(o_orderkey // 50 AS BIGINT) AS document, count(*) AS race_count FROM orders GROUP BY 1",
        "practice_session_count": (
            f"{ROLES}SELECT CAST(sum(CASE WHEN raceId % 5 = 0 THEN 1 ELSE 3 END) AS BIGINT) AS session_count FROM race"
        ),
        "doc_laps_nonempty": (
            f"{ROLES}SELECT DISTINCT CAST(l_orderkey // 50 AS BIGINT) AS document FROM line"
            " WHERE (l_orderkey // 50) % 11 <> 10"
        ),
        "doc_lap_requests": """SELECT l_orderkey AS document, CAST(unnest(range(1, n + 1)) AS INTEGER) AS lap
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)""",
        "flatten_laps": f"""{ROLES}SELECT CAST(date AS VARCHAR) AS date, CAST(lap AS VARCHAR) AS lap,
  driverRef AS driverId, time_laptimes AS time, CAST(position_laptimes AS VARCHAR) AS position
FROM lap JOIN race USING (raceId) JOIN driver USING (driverId)""",
        "flatten_pit_stops": pit("NULL"),
        "stream_drain": pit("NULL"),
        "flatten_pit_stops_lenient": pit("l_quantity"),
        "flatten_status": f"{ROLES}SELECT CAST(statusId AS INTEGER) AS statusId, status FROM status",
        "flatten_driver_standings": standings(
            "driver_standing", "driver", "driverId", "driverRef", "driverId", "driverstandings"
        ),
        "flatten_constructor_standings": standings(
            "team_standing", "team", "constructorId", "constructorRef", "constructorId", "constructorstandings"
        ),
        "doc_validate": """SELECT CASE WHEN document % 11 = 10 THEN 'missing_path' ELSE 'valid' END AS state,
  count(*) AS document_count
FROM (SELECT DISTINCT l_orderkey // 50 AS document FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
GROUP BY 1""",
    }


# -- merges -----------------------------------------------------------------------------------


def merge_statements() -> dict[str, str]:
    from ..schemas import TABLES
    from .queries import SPLIT_COUNTRY, SPLIT_NATION, SPLIT_RACE

    def columns(table: str, *skip: str) -> str:
        return ", ".join(f.name for f in TABLES[table] if f.name not in skip)

    def numbered(table: str, key: str, order: str, base: str, rows: str) -> str:
        """``rows`` with ids after the highest of ``base``, in ``order``."""
        return (
            f"SELECT {columns(table, key)}, CAST((SELECT coalesce(max({key}), 0) FROM ({base}))"
            f" + row_number() OVER (ORDER BY {order}) AS BIGINT) AS {key} FROM ({rows})"
        )

    base_driver = f"SELECT * FROM driver WHERE nationality < '{SPLIT_NATION}'"
    new_driver = f"""SELECT driverId AS arrival, * EXCLUDE (driverId) FROM (
  SELECT *, row_number() OVER (PARTITION BY driverRef ORDER BY driverId) AS rn,
         row_number() OVER (PARTITION BY driverRef, driverId // 30 ORDER BY driverId) AS rn_page FROM driver)
  WHERE (driverRef IS NULL AND rn_page = 1)
     OR (rn = 1 AND driverRef NOT IN (SELECT driverRef FROM ({base_driver}) WHERE driverRef IS NOT NULL))"""
    base_circuit = f"SELECT * FROM circuit WHERE country < '{SPLIT_COUNTRY}'"
    new_circuit = f"""SELECT circuitId AS arrival, * EXCLUDE (circuitId) REPLACE (CAST(NULL AS DOUBLE) AS alt)
  FROM circuit WHERE circuitId NOT IN (23, 24) AND circuitRef NOT IN (SELECT circuitRef FROM ({base_circuit}))"""
    base_team = f"SELECT * FROM team WHERE nationality_constructors < '{SPLIT_NATION}'"
    new_team = f"""SELECT constructorId AS arrival, * EXCLUDE (constructorId) FROM team
  WHERE constructorRef NOT IN (SELECT constructorRef FROM ({base_team}))"""
    base_race = f"SELECT * FROM race WHERE raceId <= {SPLIT_RACE}"
    new_race = f"""SELECT r.raceId AS arrival, r.* EXCLUDE (raceId)
         REPLACE (CASE WHEN r.raceId % 7 <> 0 THEN time_races END AS time_races)
  FROM race r JOIN circuit USING (circuitId) WHERE r.raceId > {SPLIT_RACE} AND country <> 'ASIA'"""

    line_order = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
    owner = "(SELECT driverRef AS ref, min(driverId) AS owner FROM driver GROUP BY driverRef)"
    lap_ms = (
        "CAST(60000 + trunc(CAST(split_part(time_laptimes, ':', 2) AS DOUBLE) * 1000) AS DOUBLE)"
    )

    def by_line(table: str, source: str, last: str, value: str, out: str) -> str:
        return f"""candidate AS (
  SELECT p.*, o.owner, row_number() OVER (PARTITION BY p.raceId, o.owner, {last} ORDER BY {line_order}) AS rn
  FROM (SELECT *, {last} AS l_linenumber FROM {source}) p
  JOIN driver d USING (driverId) JOIN {owner} o ON o.ref = d.driverRef)
SELECT raceId, owner AS driverId, {columns(table, "raceId", "driverId", out)}, {value} AS {out}
FROM candidate c WHERE rn = 1 AND NOT EXISTS (
  SELECT 1 FROM {source} b WHERE b.raceId <= {SPLIT_RACE}
    AND b.raceId = c.raceId AND b.driverId = c.owner AND b.{last} = c.{last})"""

    laps = by_line("lapsDim", "lap", "lap", lap_ms, "milliseconds_laptimes")
    pits = by_line(
        "pitStopsDim", "pit_all", "stop",
        "CASE WHEN stop % 2 = 0 THEN 60 + l_quantity + 0.5 END", "duration",
    )
    pit_all = "pit_all AS (SELECT p.* EXCLUDE (duration), duration, l_quantity FROM (SELECT race_no AS raceId, o_custkey AS driverId, l_linenumber AS stop, CAST(l_partkey % 50 + 1 AS INTEGER) AS lap_pitstops, '1' || (l_suppkey % 10) || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(l_orderkey % 60 AS VARCHAR), 2, '0') AS time_pitstops, l_quantity AS duration, l_quantity, l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM line) p)"

    new_standing = f"""SELECT s.driverStandingsId AS arrival, o.owner AS driverId, position_driverstandings,
         points_driverstandings, CAST(coalesce(wins, 0) AS INTEGER) AS wins
  FROM driver_standing s JOIN driver d USING (driverId) JOIN {owner} o ON o.ref = d.driverRef
  WHERE (s.driverStandingsId // 50) % 11 <> 10"""
    base_standing = "SELECT * FROM driver_standing WHERE position_driverstandings <= 10"
    team_key = "constructorId, position_constructorstandings, points_constructorstandings, wins_constructorstandings"
    base_team_standing = "SELECT * FROM team_standing WHERE position_constructorstandings <= 5"
    new_team_standing = f"""SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {team_key} ORDER BY arrival) AS rn FROM (
      SELECT constructorStandingsId AS arrival, constructorId, position_constructorstandings,
             CAST(coalesce(wins_constructorstandings, 0) AS INTEGER) AS wins_constructorstandings,
             points_constructorstandings
      FROM team_standing WHERE (constructorStandingsId // 50) % 11 <> 10)) n
  WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM ({base_team_standing}) b WHERE b.constructorId = n.constructorId
    AND b.position_constructorstandings = n.position_constructorstandings
    AND b.points_constructorstandings = n.points_constructorstandings
    AND b.wins_constructorstandings = n.wins_constructorstandings)"""
    base_result = f"SELECT * FROM result WHERE raceId <= {SPLIT_RACE}"
    new_result = f"""SELECT r.resultId AS arrival, raceId, r.constructorId, o.owner AS driverId,
         cs.id AS constructorStandingsId, ds.id AS driverStandingsId, statusId, positionOrder, points,
         laps, grid, fastestLapTime, CASE WHEN positionOrder <> 12 THEN fastestLapSpeed END AS fastestLapSpeed,
         time, fastestLap
  FROM result r JOIN driver d ON d.driverId = r.driverId JOIN {owner} o ON o.ref = d.driverRef
  JOIN (SELECT constructorId, min(constructorStandingsId) AS id FROM team_standing GROUP BY 1) cs
    ON cs.constructorId = r.constructorId
  JOIN (SELECT driverId, min(driverStandingsId) AS id FROM driver_standing GROUP BY 1) ds ON ds.driverId = o.owner"""

    def simple(body: str) -> str:
        return f"{ROLES}{body}"

    # all merges in a row: every lookup sees the ids that the merges before it gave
    fresh_race = f"""SELECT r.raceId AS arrival, r.* EXCLUDE (raceId) FROM race r JOIN circuit c ON c.circuitId = r.circuitId
  WHERE r.raceId > {SPLIT_RACE} AND c.circuitRef IN (SELECT circuitRef FROM all_circuit)"""

    def both(table: str, key: str, base: str, rows: str) -> str:
        return (
            f"SELECT {columns(table)} FROM ({base}) UNION ALL SELECT {columns(table)}"
            f" FROM ({numbered(table, key, 'arrival', base, rows)})"
        )

    all_merged = f"""{ROLES.rstrip()}, {pit_all},
all_driver AS ({both("driverDim", "driverId", base_driver, new_driver)}),
all_team AS ({both("constructorDim", "constructorId", base_team, new_team)}),
all_circuit AS ({both("circuitDim", "circuitId", base_circuit, new_circuit)}),
all_race AS ({both("raceDim", "raceId", base_race, fresh_race)}),
ref_driver AS (SELECT d.driverId AS old, min(a.driverId) AS new FROM driver d JOIN all_driver a USING (driverRef) GROUP BY 1),
ref_team AS (SELECT t.constructorId AS old, min(a.constructorId) AS new FROM team t JOIN all_team a USING (constructorRef) GROUP BY 1),
ref_race AS (SELECT r.raceId AS old, min(a.raceId) AS new FROM race r JOIN all_race a USING (date) GROUP BY 1),
base_driver_standing AS ({base_standing}),
new_driver_standing AS (
  SELECT d.new AS driverId FROM driver_standing s JOIN ref_driver d ON d.old = s.driverId
  WHERE (s.driverStandingsId // 50) % 11 <> 10),
base_team_standing AS ({base_team_standing}),
new_team_standing AS (
  SELECT DISTINCT t.new AS constructorId, position_constructorstandings AS p, points_constructorstandings AS o,
         coalesce(wins_constructorstandings, 0) AS w
  FROM team_standing s JOIN ref_team t ON t.old = s.constructorId
  WHERE (s.constructorStandingsId // 50) % 11 <> 10
    AND NOT EXISTS (SELECT 1 FROM base_team_standing b WHERE b.constructorId = t.new
      AND b.position_constructorstandings = s.position_constructorstandings
      AND b.points_constructorstandings = s.points_constructorstandings
      AND b.wins_constructorstandings = coalesce(s.wins_constructorstandings, 0)))"""

    def keyed(source: str, last: str) -> str:
        """Rows of a table by race, driver and number: those from before, and new keys."""
        return f"""(SELECT count(*) FROM {source} WHERE raceId <= {SPLIT_RACE}) + (SELECT count(*) FROM (
  SELECT DISTINCT r.new AS race, d.new AS driver, {last} AS n FROM {source} s
  JOIN ref_race r ON r.old = s.raceId JOIN ref_driver d ON d.old = s.driverId) k
  WHERE NOT EXISTS (SELECT 1 FROM {source} b WHERE b.raceId <= {SPLIT_RACE}
    AND b.raceId = k.race AND b.driverId = k.driver AND b.{last} = k.n))"""

    totals = {
        "driverDim": "(SELECT count(*) FROM all_driver)",
        "constructorDim": "(SELECT count(*) FROM all_team)",
        "circuitDim": "(SELECT count(*) FROM all_circuit)",
        "raceStatusDim": "(SELECT count(*) FROM status)",
        "raceDim": "(SELECT count(*) FROM all_race)",
        "freePracticeDim": f"""(SELECT count(*) FROM practice WHERE raceId <= {SPLIT_RACE}) + (
  SELECT count(DISTINCT new) FROM ref_race WHERE new NOT IN (SELECT raceId FROM practice WHERE raceId <= {SPLIT_RACE}))""",
        "lapsDim": keyed("lap", "lap"),
        "pitStopsDim": keyed("pit_all", "stop"),
        "driverStandingsDim": "(SELECT count(*) FROM base_driver_standing) + (SELECT count(*) FROM new_driver_standing)",
        "constructorStandingsDim": "(SELECT count(*) FROM base_team_standing) + (SELECT count(*) FROM new_team_standing)",
        "raceResultsFact": f"""(SELECT count(*) FROM ({base_result})) + (SELECT count(*) FROM result s
  JOIN ref_race r ON r.old = s.raceId JOIN ref_driver d ON d.old = s.driverId JOIN ref_team t ON t.old = s.constructorId
  WHERE d.new IN (SELECT driverId FROM base_driver_standing UNION SELECT driverId FROM new_driver_standing)
    AND t.new IN (SELECT constructorId FROM base_team_standing UNION SELECT constructorId FROM new_team_standing))""",
    }
    merge_all = all_merged + " UNION ALL ".join(
        f"\nSELECT '{table}' AS table_name, CAST({total} AS BIGINT) AS row_count" for table, total in totals.items()
    )

    return {
        "merge_all_counts": merge_all,
        "stream_merge_all": merge_all,
        "merge_driver": simple(numbered("driverDim", "driverId", "arrival", base_driver, new_driver)),
        "merge_circuit": simple(numbered("circuitDim", "circuitId", "arrival", base_circuit, new_circuit)),
        "merge_constructor": simple(
            numbered("constructorDim", "constructorId", "arrival", base_team, new_team)
        ),
        "merge_constructor_upsert": simple(
            f"SELECT {columns('constructorDim')} FROM ({base_team}) UNION ALL SELECT {columns('constructorDim')}"
            f" FROM ({numbered('constructorDim', 'constructorId', 'arrival', base_team, new_team)})"
        ),
        "merge_race": simple(numbered("raceDim", "raceId", "arrival", base_race, new_race)),
        "merge_practice": simple(f"SELECT * FROM practice WHERE raceId > {SPLIT_RACE}"),
        "merge_laps": f"{ROLES.rstrip()}, {laps}",
        "merge_pit_stops": f"{ROLES.rstrip()}, {pit_all}, {pits}",
        "merge_status": simple(
            "SELECT status, CAST((SELECT max(statusId) FROM status WHERE status < 'C')"
            " + row_number() OVER (ORDER BY statusId) AS BIGINT) AS statusId FROM status WHERE status >= 'C'"
        ),
        "merge_driver_standings": simple(
            numbered("driverStandingsDim", "driverStandingsId", "arrival", base_standing, new_standing)
        ),
        "merge_constructor_standings": simple(
            numbered(
                "constructorStandingsDim", "constructorStandingsId", "arrival", base_team_standing, new_team_standing
            )
        ),
        "merge_results": simple(numbered("raceResultsFact", "resultId", "arrival", base_result, new_result)),
        "merge_results_rejects": simple(
            """SELECT CASE WHEN statusId <> 2 THEN 'missing_status' ELSE 'missing_driver' END AS reason,
  count(*) AS row_count FROM result JOIN driver USING (driverId)
WHERE statusId <> 2 OR driverRef IS NULL GROUP BY 1"""
        ),
        "merge_audit": f"""{ROLES.rstrip()}, n AS (
  SELECT l.raceId, o.owner, l.lap, count(*) AS n,
         bool_or(b.raceId IS NOT NULL) AS known
  FROM lap l JOIN driver d USING (driverId) LEFT JOIN {owner} o ON o.ref = d.driverRef
  LEFT JOIN (SELECT DISTINCT raceId, driverId, lap FROM lap WHERE raceId <= {SPLIT_RACE}) b
    ON b.raceId = l.raceId AND b.driverId = o.owner AND b.lap = l.lap
  GROUP BY l.raceId, o.owner, l.lap)
SELECT 'lapsDim' AS table_name, outcome, CAST(sum(c) AS BIGINT) AS row_count FROM (
  SELECT 'missing_driver' AS outcome, n AS c FROM n WHERE owner IS NULL
  UNION ALL SELECT 'exists', n FROM n WHERE owner IS NOT NULL AND known
  UNION ALL SELECT 'inserted', 1 FROM n WHERE owner IS NOT NULL AND NOT known
  UNION ALL SELECT 'repeated', n - 1 FROM n WHERE owner IS NOT NULL AND NOT known)
GROUP BY outcome HAVING sum(c) > 0""",
        "upsert_by_key": simple("SELECT * REPLACE (surname || ' II' AS surname) FROM driver"),
        "allocate_ids": (
            "SELECT o_totalprice, o_orderkey,"
            " 100 + row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS new_id FROM orders"
        ),
        "stream_merge_driver": simple(
            f"""SELECT driverRef, count(*) AS row_count, count(*) AS id_count FROM (
  SELECT driverRef FROM ({base_driver}) UNION ALL SELECT driverRef FROM ({new_driver})) GROUP BY driverRef"""
        ),
        "stream_merge_laps": f"""{ROLES.rstrip()}, {laps.split("SELECT raceId, owner AS driverId", 1)[0]}
SELECT raceId, count(*) AS lap_count FROM (
  SELECT raceId FROM lap WHERE raceId <= {SPLIT_RACE}
  UNION ALL SELECT raceId FROM candidate c WHERE rn = 1 AND NOT EXISTS (
    SELECT 1 FROM lap b WHERE b.raceId <= {SPLIT_RACE}
      AND b.raceId = c.raceId AND b.driverId = c.owner AND b.lap = c.lap)) GROUP BY raceId""",
    }


# -- profiling and checks ---------------------------------------------------------------------


def profile_statements() -> dict[str, str]:
    from ..schemas import PRIMARY_KEYS, REFERENCES, TABLES

    ctes = {
        "driverDim": "driver",
        "constructorDim": "team",
        "circuitDim": "circuit",
        "raceDim": "race",
        "raceStatusDim": "status",
        "driverStandingsDim": "driver_standing",
        "constructorStandingsDim": "team_standing",
        "pitStopsDim": "pit",
        "lapsDim": "lap",
        "qualificationsDim": "qualifying",
        "freePracticeDim": "practice",
        "sprintDim": "sprint",
        "raceResultsFact": "result",
    }
    nulls = ", ".join(f"bool_or({f.name} IS NULL) AS {f.name}" for f in TABLES["raceResultsFact"])
    keys = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) FILTER (WHERE {k} IS NULL) AS null_keys,"
        f" count(DISTINCT {k}) FILTER (WHERE n > 1) AS duplicate_keys"
        f" FROM (SELECT {k}, count(*) OVER (PARTITION BY {k}) AS n FROM {ctes[t]})"
        for t, k in PRIMARY_KEYS.items()
    )
    orphans = " UNION ALL ".join(
        f"SELECT '{child}' AS child_table, '{column}' AS child_column, '{parent}' AS parent_table,"
        f" count(*) AS orphan_rows, count(DISTINCT {column}) AS orphan_values FROM {ctes[child]}"
        f" WHERE {column} IS NOT NULL AND {column} NOT IN"
        f" (SELECT {parent_column} FROM {ctes[parent]} WHERE {parent_column} IS NOT NULL)"
        for child, column, parent, parent_column in REFERENCES
    )
    bodies = {
        "profile_shape": "SELECT count(*) AS row_count, CAST(6 AS BIGINT) AS column_count FROM lap",
        "profile_minmax": "SELECT min(year) AS min_value, max(year) AS max_value FROM race",
        "profile_dup_key": "SELECT count(*) > count(DISTINCT driverId) AS has_duplicates FROM result",
        "profile_dup_rows": (
            "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM"
            " (SELECT count(*) AS n FROM sprint GROUP BY raceId, driverId, sprint_date, sprint_time)"
        ),
        "profile_nulls": f"SELECT {nulls} FROM result",
        "profile_mismatch": (
            "SELECT resultId, positionOrder IS DISTINCT FROM grid"
            " AND (SELECT bool_and(grid IS NOT NULL) FROM result) AS is_mismatch FROM result"
        ),
        "profile_top_values": (
            "SELECT driverId AS value, count(*) AS row_count FROM result WHERE driverId IS NOT NULL"
            " GROUP BY 1 ORDER BY row_count DESC, value LIMIT 30"
        ),
        "profile_distinct": "SELECT DISTINCT circuitId FROM race",
        "profile_col_equal": (
            "SELECT bool_and(constructorStandingsId IS NOT DISTINCT FROM driverStandingsId) AS is_equal"
            " FROM result"
        ),
        "check_pk": keys,
        "profile_sample": (
            "SELECT * FROM result ORDER BY md5('1:' || resultId), resultId LIMIT 10"
        ),
        "check_fk": orphans,
    }
    return {key: f"{ROLES}{body}" for key, body in bodies.items()}


# Queries that reach the rows of another one by another way.
SAME_ROWS = {
    "stream_then_batch": "stream_merge_driver",
    "stream_merge_pit_records": "merge_pit_stops",
    "stream_merge_status_records": "merge_status",
    "stream_merge_results_records": "merge_results",
}


def all_statements() -> dict[str, str]:
    from .queries import DRIVER, DRIVER_YEAR, TEAM_YEAR

    statements = {
        **view_statements(DRIVER, DRIVER_YEAR, TEAM_YEAR),
        **source_statements(),
        **star_statements(),
        **document_statements(),
        **merge_statements(),
        **profile_statements(),
    }
    return statements | {name: statements[twin] for name, twin in SAME_ROWS.items()}
