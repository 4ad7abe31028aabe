"""The analytic questions over the star schema, as parameterised DataFrame functions.

Facts are aggregated on ids first and joined to names afterwards: the wide name columns then travel
once per group instead of once per fact row, and a driver or team that owns most of the fact is
reduced to one row per map task before any shuffle. Names are regrouped at the end because two ids
may carry one reference.

``ordered`` adds the question's sort, a range shuffle of the result; switch it off when the result
is written to a table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.times import as_interval, seconds_of_day
from ..operators.runs import add_stretches, longest_runs

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Entity:
    """Who a question is about: where the names are, and what they are called in results."""

    table: str
    id_column: str
    names: tuple[tuple[str, str], ...]
    standings: str
    standings_id: str
    standings_wins: str
    details: tuple[tuple[str, str], ...]

    @property
    def labels(self) -> list[str]:
        return [label for _, label in self.names]

    def lookup(self, tables: Tables, details: bool = False) -> DataFrame:
        columns = self.names + (self.details if details else ())
        return tables[self.table].select(
            self.id_column, *[F.col(c).alias(label) for c, label in columns]
        )


DRIVER = Entity(
    table="driverDim",
    id_column="driverId",
    names=(
        ("driverRef", "driver_reference"),
        ("forename", "driver_forename"),
        ("surname", "driver_surname"),
    ),
    standings="driverStandingsDim",
    standings_id="driverStandingsId",
    standings_wins="wins",
    details=(
        ("dob", "driver_dob"),
        ("nationality", "driver_nationality"),
        ("code", "driver_code"),
    ),
)

CONSTRUCTOR = Entity(
    table="constructorDim",
    id_column="constructorId",
    names=(("constructorRef", "constructor_reference"), ("name", "constructor_name")),
    standings="constructorStandingsDim",
    standings_id="constructorStandingsId",
    standings_wins="wins_constructorstandings",
    details=(("nationality_constructors", "constructor_nationality"),),
)

# What can be said about a set of results: partial aggregates per id, and how to finish them.
_PARTIALS = {
    "_points": "sum(points)",
    "_places": "sum(cast(positionOrder as bigint))",
    "_placed": "count(positionOrder)",
    "_results": "count(resultId)",
    "_wins": "count_if(positionOrder = 1)",
    "_podiums": "count_if(positionOrder <= 3)",
    "_highest": "max(positionOrder)",
    "_lowest": "min(positionOrder)",
}
_MEASURES = {
    "avg_finish_position": (("_places", "_placed"), "try_divide(sum(_places), sum(_placed))"),
    "total_points": (("_points",), "sum(_points)"),
    "races_count": (("_results",), "sum(_results)"),
    "wins": (("_wins",), "sum(_wins)"),
    "wins_count": (("_wins",), "sum(_wins)"),
    "podiums": (("_podiums",), "sum(_podiums)"),
    "podiums_count": (("_podiums",), "sum(_podiums)"),
    # The labels are swapped on purpose: "best" is the highest place number.
    "best_finish_position": (("_highest",), "max(_highest)"),
    "worst_finish_position": (("_lowest",), "min(_lowest)"),
}


def _partials(measures: Sequence[str]) -> list[Column]:
    needed = dict.fromkeys(p for m in measures for p in _MEASURES[m][0])
    return [F.expr(_PARTIALS[p]).alias(p) for p in needed]


def _finals(measures: Sequence[str]) -> list[Column]:
    return [F.expr(_MEASURES[m][1]).alias(m) for m in measures]


def _sorted(df: DataFrame, ordered: bool, *keys: Column) -> DataFrame:
    return df.orderBy(*keys) if ordered else df


def _asc(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def _only_year(races: DataFrame, year: int) -> DataFrame:
    """Races of one year, as a date range that reaches the scan."""
    return races.where(
        (F.col("date") >= F.make_date(F.lit(year), F.lit(1), F.lit(1)))
        & (F.col("date") < F.make_date(F.lit(year + 1), F.lit(1), F.lit(1)))
    )


# -- season and career rollups ----------------------------------------------------------------


def season_rollup(tables: Tables, entity: Entity, measures: Sequence[str]) -> DataFrame:
    """Measures per entity and season."""
    per_id = (
        tables["raceResultsFact"]
        .join(tables["raceDim"].select("raceId", F.col("year").alias("season_year")), "raceId")
        .groupBy(entity.id_column, "season_year")
        .agg(*_partials(measures))
    )
    named = per_id.join(entity.lookup(tables), entity.id_column)
    return named.groupBy(*entity.labels, "season_year").agg(*_finals(measures))


def _season_view(
    tables: Tables, entity: Entity, measures: Sequence[str], ordered: bool = True
) -> DataFrame:
    rollup = season_rollup(tables, entity, measures)
    return _sorted(rollup, ordered, *_asc(entity.labels[0], "season_year", *entity.labels[1:]))


def driver_trends(tables: Tables, ordered: bool = True) -> DataFrame:
    """Average place, points, results, wins and podiums per driver and season."""
    measures = ["avg_finish_position", "total_points", "races_count", "wins", "podiums"]
    return _season_view(tables, DRIVER, measures, ordered)


def driver_season_comparison(tables: Tables, ordered: bool = True) -> DataFrame:
    """The same question as :func:`driver_trends`, under its second name."""
    return driver_trends(tables, ordered)


def driver_season_performance(tables: Tables, ordered: bool = True) -> DataFrame:
    """Points, wins and average place per driver and season."""
    return _season_view(tables, DRIVER, ["total_points", "wins", "avg_finish_position"], ordered)


def constructor_season_comparison(tables: Tables, ordered: bool = True) -> DataFrame:
    """Average place, points, results, wins and podiums per team and season."""
    measures = ["avg_finish_position", "total_points", "races_count", "wins", "podiums"]
    return _season_view(tables, CONSTRUCTOR, measures, ordered)


def constructor_season_performance(tables: Tables, ordered: bool = True) -> DataFrame:
    """Points, wins and average place per team and season."""
    measures = ["total_points", "wins", "avg_finish_position"]
    return _season_view(tables, CONSTRUCTOR, measures, ordered)


def constructor_over_seasons(tables: Tables, ordered: bool = True) -> DataFrame:
    """Points, results, races entered, wins and podiums per team and season.

    The fact is first reduced to one row per team and race, so the distinct count that follows
    sees at most the season's races per team.
    """
    measures = ["total_points", "races_count", "wins", "podiums"]
    per_race = (
        tables["raceResultsFact"].groupBy("constructorId", "raceId").agg(*_partials(measures))
    )
    named = per_race.join(
        tables["raceDim"].select("raceId", F.col("year").alias("season_year")), "raceId"
    ).join(CONSTRUCTOR.lookup(tables), "constructorId")
    result = named.groupBy(*CONSTRUCTOR.labels, "season_year").agg(
        *_finals(measures), F.countDistinct("raceId").alias("races_entered")
    )
    columns = ["total_points", "races_count", "races_entered", "wins", "podiums"]
    result = result.select(*CONSTRUCTOR.labels, "season_year", *columns)
    return _sorted(
        result, ordered, *_asc("constructor_reference", "season_year", "constructor_name")
    )


def _career(tables: Tables, keep: Column, ordered: bool, few: bool = False) -> DataFrame:
    """``few``: the filter keeps few drivers, so facts meet their ids before they are summed."""
    measures = ["avg_finish_position", "total_points", "wins_count"]
    kept = DRIVER.lookup(tables).where(keep)
    facts = tables["raceResultsFact"]
    if few:
        facts = facts.join(kept.select("driverId"), "driverId", "left_semi")
    named = facts.groupBy("driverId").agg(*_partials(measures)).join(kept, "driverId")
    result = named.groupBy(*DRIVER.labels).agg(*_finals(measures))
    return _sorted(result, ordered, *_asc(*DRIVER.labels))


def career_excluding(tables: Tables, driver: str, ordered: bool = True) -> DataFrame:
    """Career averages of everybody but one driver; drivers without a reference drop out."""
    return _career(tables, F.col("driver_reference") != driver, ordered)


def career_only(tables: Tables, driver: str, ordered: bool = True) -> DataFrame:
    """Career averages of one driver."""
    return _career(tables, F.col("driver_reference") == driver, ordered, few=True)


def season_record(tables: Tables, measure: str, excluding: str | None = None) -> DataFrame:
    """The best driver season by one measure; equal values go to the lower reference and year."""
    rollup = season_rollup(tables, DRIVER, [measure])
    if excluding is not None:
        rollup = rollup.where(F.col("driver_reference") != excluding)
    return rollup.orderBy(
        F.col(measure).desc_nulls_first(),
        *_asc("driver_reference", "season_year", "driver_forename", "driver_surname"),
    ).limit(1)


def most_wins_season(tables: Tables) -> DataFrame:
    return season_record(tables, "wins_count")


def most_wins_season_excluding(tables: Tables, driver: str) -> DataFrame:
    return season_record(tables, "wins_count", driver)


def most_podiums_season(tables: Tables) -> DataFrame:
    return season_record(tables, "podiums_count")


def most_podiums_season_excluding(tables: Tables, driver: str) -> DataFrame:
    return season_record(tables, "podiums_count", driver)


def most_points_season(tables: Tables) -> DataFrame:
    return season_record(tables, "total_points")


def most_points_season_excluding(tables: Tables, driver: str) -> DataFrame:
    return season_record(tables, "total_points", driver)


# -- wins in a year ---------------------------------------------------------------------------


def wins_in_year(
    tables: Tables, entity: Entity, year: int, wins_label: str, ordered: bool = True
) -> DataFrame:
    """Per reference, its standings row with the most wins among the races of one year.

    Standings are cumulative; the year only picks which standings rows count. A row without a win
    count ranks first. The year's races cut the fact before it meets the standings.
    """
    fact = tables["raceResultsFact"].join(
        _only_year(tables["raceDim"], year).select("raceId"), "raceId"
    )
    standings = tables[entity.standings].select(
        entity.standings_id, entity.id_column, F.col(entity.standings_wins).alias(wins_label)
    )
    ids = [entity.standings_id, entity.id_column]
    joined = (
        fact.select(entity.standings_id)
        .join(standings, entity.standings_id)
        .join(entity.lookup(tables, details=True), entity.id_column)
    )
    reference = entity.labels[0]
    rank = Window.partitionBy(reference).orderBy(F.col(wins_label).desc_nulls_first(), *_asc(*ids))
    best = joined.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1")
    details = [label for _, label in entity.details]
    result = best.select(*entity.labels, *details, F.col(wins_label))
    return _sorted(result, ordered, F.col(wins_label).desc_nulls_first(), *_asc(*entity.labels))


def driver_wins_in_year(
    tables: Tables, year: int, wins_label: str = "wins_in_year", ordered: bool = True
) -> DataFrame:
    return wins_in_year(tables, DRIVER, year, wins_label, ordered)


def constructor_wins_in_year(
    tables: Tables, year: int, wins_label: str = "wins_in_year", ordered: bool = True
) -> DataFrame:
    return wins_in_year(tables, CONSTRUCTOR, year, wins_label, ordered)


# -- circuits, pit stops, qualifying ----------------------------------------------------------


def driver_by_circuit(tables: Tables, ordered: bool = True) -> DataFrame:
    """Average place, results, points and extreme places per driver and circuit."""
    measures = [
        "avg_finish_position",
        "races_count",
        "total_points",
        "best_finish_position",
        "worst_finish_position",
    ]
    per_id = (
        tables["raceResultsFact"]
        .join(tables["raceDim"].select("raceId", "circuitId"), "raceId")
        .groupBy("driverId", "circuitId")
        .agg(*_partials(measures))
    )
    circuits = tables["circuitDim"].select(
        "circuitId",
        F.col("name_y").alias("circuit_name"),
        F.col("country").alias("circuit_country"),
    )
    named = per_id.join(circuits, "circuitId").join(DRIVER.lookup(tables), "driverId")
    group = [
        *DRIVER.labels,
        F.col("circuitId").alias("circuit_id"),
        "circuit_name",
        "circuit_country",
    ]
    result = named.groupBy(*group).agg(*_finals(measures))
    return _sorted(
        result,
        ordered,
        *_asc("driver_reference", "circuit_name", "driver_forename", "driver_surname"),
    )


def circuit_records(tables: Tables, mode: str = "reference", ordered: bool = True) -> DataFrame:
    """Fastest laps with circuit, season and driver.

    ``reference`` lists every result that has a fastest lap, by circuit, season and lap time text;
    ``record`` keeps only the first of each circuit by lap time text.
    """
    laps = (
        tables["raceResultsFact"]
        .where(F.col("fastestLapTime").isNotNull())
        .select(
            "resultId",
            "raceId",
            "driverId",
            F.col("fastestLapTime").alias("fastest_lap_time"),
            F.col("fastestLapSpeed").alias("fastest_lap_speed"),
        )
        .join(
            tables["raceDim"].select("raceId", "circuitId", F.col("year").alias("season_year")),
            "raceId",
        )
    )
    if mode == "record":
        first = Window.partitionBy("circuitId").orderBy("fastest_lap_time", "resultId")
        laps = laps.withColumn("_rn", F.row_number().over(first)).where("_rn = 1")
    circuits = tables["circuitDim"].select("circuitId", F.col("name_y").alias("circuit_name"))
    named = laps.join(circuits, "circuitId").join(DRIVER.lookup(tables), "driverId")
    result = named.select(
        "circuit_name", "season_year", *DRIVER.labels, "fastest_lap_time", "fastest_lap_speed"
    )
    return _sorted(
        result,
        ordered,
        *_asc("circuit_name", "season_year", "fastest_lap_time", *DRIVER.labels),
    )


def pit_stop_effectiveness(tables: Tables, ordered: bool = True) -> DataFrame:
    """Stops and average stop duration per season, team, driver and finishing place.

    Both sides of the (race, driver) join are reduced to counts and sums first, so a pair with many
    stops and many results meets as a few rows; the counts are multiplied instead of the rows.
    """
    stops = (
        tables["pitStopsDim"]
        .groupBy("raceId", "driverId")
        .agg(
            F.count("stop").alias("_stops"),
            F.sum("duration").alias("_seconds"),
            F.count("duration").alias("_timed"),
        )
    )
    results = (
        tables["raceResultsFact"]
        .groupBy("raceId", "driverId", "constructorId", "positionOrder")
        .agg(F.count(F.lit(1)).alias("_results"))
    )
    pairs = results.join(stops, ["raceId", "driverId"])
    per_id = (
        pairs.join(tables["raceDim"].select("raceId", F.col("year").alias("season_year")), "raceId")
        .groupBy("season_year", "constructorId", "driverId", "positionOrder")
        .agg(
            *[
                F.sum(F.col(c) * F.col("_results")).alias(c)
                for c in ("_stops", "_seconds", "_timed")
            ]
        )
    )
    teams = tables["constructorDim"].select("constructorId", F.col("name").alias("constructor_name"))
    named = per_id.join(teams, "constructorId").join(DRIVER.lookup(tables), "driverId")
    group = [
        "season_year",
        "constructor_name",
        *DRIVER.labels,
        F.col("positionOrder").alias("finish_position"),
    ]
    result = named.groupBy(*group).agg(
        F.sum("_stops").alias("pit_stops_count"),
        F.try_divide(F.sum("_seconds"), F.sum("_timed")).alias("avg_pit_stop_duration"),
    )
    return _sorted(
        result,
        ordered,
        *_asc("season_year", "constructor_name", *DRIVER.labels, "finish_position"),
    )


def driver_qualifying(tables: Tables, ordered: bool = True) -> DataFrame:
    """Average qualifying time of day in seconds, and how often it is midnight, per driver."""
    seconds = seconds_of_day(F.col("quali_time"))
    per_id = (
        tables["qualificationsDim"]
        .select("driverId", seconds.alias("_s"))
        .groupBy("driverId")
        .agg(
            F.sum("_s").alias("_seconds"),
            F.count("_s").alias("_timed"),
            F.count(F.when(F.col("_s") == 0, 1)).alias("_poles"),
        )
    )
    result = (
        per_id.join(DRIVER.lookup(tables), "driverId")
        .groupBy(*DRIVER.labels)
        .agg(
            F.try_divide(F.sum("_seconds"), F.sum("_timed")).alias("avg_qualifying_seconds"),
            F.sum("_poles").alias("pole_positions"),
        )
    )
    return _sorted(result, ordered, *_asc("avg_qualifying_seconds", *DRIVER.labels))


# -- streaks ----------------------------------------------------------------------------------


def streaks(tables: Tables, entity: Entity) -> DataFrame:
    """Longest podium run and longest winning run per entity, over its results by date.

    A history belongs to a reference (all unnamed ones share one), and is counted per set of names
    within it. Results on one date are taken in result id order.
    """
    names = entity.lookup(tables)
    members = _lowest_id(names, entity, entity.labels, "_member")
    members = _lowest_id(members, entity, entity.labels[:1], "_history").select(
        entity.id_column, "_member", "_history"
    )
    rows = (
        tables["raceResultsFact"]
        .select("resultId", "raceId", entity.id_column, "positionOrder")
        .join(tables["raceDim"].select("raceId", "date"), "raceId")
        .join(members, entity.id_column)
    )
    flags = {
        "longest_podium_streak": F.col("positionOrder") <= 3,
        "longest_winning_streak": F.col("positionOrder") == 1,
    }
    cut = add_stretches(rows, "_history", "date")
    order = ["date", "resultId"]
    runs = longest_runs(cut, "_history", "_member", order, flags, F.col("_part"))
    labelled = names.withColumnRenamed(entity.id_column, "_member")
    return runs.join(labelled, "_member").select(*entity.labels, *flags)


def _lowest_id(names: DataFrame, entity: Entity, group: Sequence[str], into: str) -> DataFrame:
    """Add the lowest id among the rows that agree on ``group``; nulls agree with each other."""
    lowest = names.groupBy(*[F.col(g).alias(f"_{g}") for g in group]).agg(
        F.min(entity.id_column).alias(into)
    )
    agree = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group]
    return names.join(lowest, agree).drop(*[f"_{g}" for g in group])


def _streak_view(tables: Tables, entity: Entity, ordered: bool) -> DataFrame:
    # winning runs are matched to podium runs by equal names, and a null name equals nothing
    named = F.lit(True)
    for label in entity.labels:
        named = named & F.col(label).isNotNull()
    result = (
        streaks(tables, entity)
        .where("longest_podium_streak > 0")
        .withColumn(
            "longest_winning_streak", F.when(named, F.col("longest_winning_streak")).otherwise(0)
        )
    )
    return _sorted(
        result,
        ordered,
        F.desc("longest_podium_streak"),
        F.desc("longest_winning_streak"),
        *_asc(*entity.labels),
    )


def driver_streaks(tables: Tables, ordered: bool = True) -> DataFrame:
    """Longest podium and winning runs of drivers that reached a podium."""
    return _streak_view(tables, DRIVER, ordered)


def constructor_streaks(tables: Tables, ordered: bool = True) -> DataFrame:
    """Longest podium and winning runs of teams that reached a podium, counted in results."""
    return _streak_view(tables, CONSTRUCTOR, ordered)


def most_wins_in_row(tables: Tables, mode: str = "reference") -> DataFrame:
    """The driver with the most wins in a row.

    ``reference`` filters to wins before it numbers the rows, which makes every career one run, so
    the answer is the most career wins; ``consecutive`` answers the question itself.
    """
    if mode == "consecutive":
        found = streaks(tables, DRIVER).where("longest_winning_streak > 0")
        found = found.select(*DRIVER.labels, F.col("longest_winning_streak").alias("wins_in_a_row"))
    else:
        wins = (
            tables["raceResultsFact"]
            .where("positionOrder = 1")
            # a result counts only if its race is known
            .join(tables["raceDim"].select("raceId"), "raceId", "left_semi")
            .groupBy("driverId")
            .agg(F.count(F.lit(1)).alias("_wins"))
        )
        found = (
            wins.join(DRIVER.lookup(tables), "driverId")
            .groupBy(*DRIVER.labels)
            .agg(F.sum("_wins").alias("wins_in_a_row"))
        )
    return found.orderBy(F.desc("wins_in_a_row"), *_asc(*DRIVER.labels)).limit(1)


# -- installation -----------------------------------------------------------------------------


def view_plans(
    driver: str = "max_verstappen",
    driver_year: int = 2023,
    constructor_year: int = 2024,
    ordered: bool = True,
) -> dict[str, Callable[[Tables], DataFrame]]:
    """Every view under its published name. The names and the default parameters."""

    def qualifying(tables: Tables) -> DataFrame:
        found = driver_qualifying(tables, ordered)
        return found.select(
            *DRIVER.labels,
            as_interval(F.col("avg_qualifying_seconds")).alias("avg_qualifying_time"),
            "pole_positions",
        )

    by_order = {"ordered": ordered}
    return {
        "DriverWins2023View": partial(
            driver_wins_in_year,
            year=driver_year,
            wins_label=f"wins_in_{driver_year}",
            **by_order,
        ),
        "ConstructorWins2024View": partial(
            constructor_wins_in_year,
            year=constructor_year,
            wins_label=f"wins_in_{constructor_year}",
            **by_order,
        ),
        "DriverPerformanceByCircuitView": partial(driver_by_circuit, **by_order),
        "ConstructorPerformanceOverSeasonsView": partial(constructor_over_seasons, **by_order),
        "DriverPerformanceTrendsView": partial(driver_trends, **by_order),
        "CircuitRecordsView": partial(circuit_records, **by_order),
        "PitStopEffectivenessView": partial(pit_stop_effectiveness, **by_order),
        "DriverWinningPodiumStreaksView": partial(driver_streaks, **by_order),
        "ConstructorWinningPodiumStreaksView": partial(constructor_streaks, **by_order),
        "ConstructorSeasonalComparisonsView": partial(constructor_season_comparison, **by_order),
        "DriverSeasonalComparisonsView": partial(driver_season_comparison, **by_order),
        "DriverQualificationPerformanceView": qualifying,
        "DriverSeasonalPerformanceView": partial(driver_season_performance, **by_order),
        "ConstructorSeasonalPerformanceView": partial(constructor_season_performance, **by_order),
        "DriverPerformanceWithoutMaxView": partial(career_excluding, driver=driver, **by_order),
        "DriverPerformanceWithMaxView": partial(career_only, driver=driver, **by_order),
        "DriverMostWinsInSeasonView": most_wins_season,
        "DriverMostWinsInSeasonWithoutMaxView": partial(
            most_wins_season_excluding, driver=driver
        ),
        "DriverMostWinsInRowView": most_wins_in_row,
        "DriverMostPodiumsInSeasonView": most_podiums_season,
        "DriverMostPodiumsInSeasonWithoutMaxView": partial(
            most_podiums_season_excluding, driver=driver
        ),
        "DriverMostPointsInSeasonView": most_points_season,
        "DriverMostPointsInSeasonWithoutMaxView": partial(
            most_points_season_excluding, driver=driver
        ),
    }


def register_views(spark: SparkSession, tables: Tables, **parameters) -> list[str]:
    """Create or replace a temporary view per question; returns their names."""
    plans = view_plans(**parameters)
    for name, plan in plans.items():
        plan(tables).createOrReplaceTempView(name)
    return list(plans)


def save_views(tables: Tables, path: str, **parameters) -> list[str]:
    """Write every question's answer as Parquet below ``path``, unsorted."""
    plans = view_plans(**{"ordered": False, **parameters})
    for name, plan in plans.items():
        plan(tables).write.mode("overwrite").parquet(f"{path}/{name}")
    return list(plans)
