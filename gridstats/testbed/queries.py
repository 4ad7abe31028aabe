"""Registered queries: every operator over the roles of one folder of test tables."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Mapping
from functools import reduce

from pyarrow.dataset import dataset
from pyarrow.fs import FileSystem, FileType
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import to_day
from ..functions.times import millis_interval
from ..operators import profile
from ..operators.checks import check_primary_keys, check_references
from ..operators.dedupe import distinct_project, first_per_key
from ..operators.ids import allocate_ids
from ..operators.merge import upsert_by_key
from ..plans import flatten, views
from ..plans.loads import LOADS, as_records, merge_all
from ..plans.star import split_all, split_table
from ..session import scratch_path
from ..sources import csv, documents
from ..sources.requests import read_requests
from ..sources.tables import StarTables, count_rows
from ..sources.topics import stream_folder, stream_messages, write_messages
from ..streaming.merge_stream import append_stream, merge_all_stream, merge_stream
from . import documents as docs
from .roles import Roles

DRIVER = "driver_1"
DRIVER_YEAR = 1998
TEAM_YEAR = 1999
# What is loaded before the increment arrives.
SPLIT_RACE = 1096
SPLIT_NATION = "NATION_2"
SPLIT_COUNTRY = "C"
# Rounds that one task asks for.
ROUNDS = 61

Query = Callable[[SparkSession, str], DataFrame]


def _on_roles(plan: Callable[..., DataFrame], **parameters) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plan(Roles(spark, folder), **parameters)

    return run


# -- analytic views ---------------------------------------------------------------------------


def view_queries() -> dict[str, Query]:
    plans = {
        "driver_wins_in_year": (views.driver_wins_in_year, {"year": DRIVER_YEAR}),
        "constructor_wins_in_year": (views.constructor_wins_in_year, {"year": TEAM_YEAR}),
        "driver_by_circuit": (views.driver_by_circuit, {}),
        "constructor_over_seasons": (views.constructor_over_seasons, {}),
        "driver_trends": (views.driver_trends, {}),
        "circuit_records": (views.circuit_records, {}),
        "circuit_record_holders": (views.circuit_records, {"mode": "record"}),
        "pit_stop_effectiveness": (views.pit_stop_effectiveness, {}),
        "driver_streaks": (views.driver_streaks, {}),
        "constructor_streaks": (views.constructor_streaks, {}),
        "constructor_season_comparison": (views.constructor_season_comparison, {}),
        "driver_season_comparison": (views.driver_season_comparison, {}),
        "driver_qualifying": (views.driver_qualifying, {}),
        "driver_season_performance": (views.driver_season_performance, {}),
        "constructor_season_performance": (views.constructor_season_performance, {}),
        "career_excluding": (views.career_excluding, {"driver": DRIVER}),
        "career_only": (views.career_only, {"driver": DRIVER}),
        "most_wins_season": (views.most_wins_season, {}),
        "most_wins_season_excl": (views.most_wins_season_excluding, {"driver": DRIVER}),
        "most_wins_in_row": (views.most_wins_in_row, {}),
        "most_wins_in_row_true": (views.most_wins_in_row, {"mode": "consecutive"}),
        "most_podiums_season": (views.most_podiums_season, {}),
        "most_podiums_season_excl": (views.most_podiums_season_excluding, {"driver": DRIVER}),
        "most_points_season": (views.most_points_season, {}),
        "most_points_season_excl": (views.most_points_season_excluding, {"driver": DRIVER}),
    }
    return {name: _on_roles(plan, **args) for name, (plan, args) in plans.items()}


def register_views(spark: SparkSession, folder: str) -> DataFrame:
    """Install all views, then ask two of them a question in SQL."""
    views.register_views(
        spark,
        Roles(spark, folder),
        driver=DRIVER,
        driver_year=DRIVER_YEAR,
        constructor_year=TEAM_YEAR,
        ordered=False,
    )
    return spark.sql(
        """
        SELECT t.season_year, count(*) AS driver_count, sum(t.podiums) AS podiums,
               sum(t.total_points) AS total_points
        FROM DriverPerformanceTrendsView t
        JOIN DriverPerformanceWithoutMaxView c
          ON t.driver_reference = c.driver_reference AND t.driver_surname = c.driver_surname
        WHERE c.wins_count > 0
        GROUP BY t.season_year
        """
    )


# -- sources and cleaning ---------------------------------------------------------------------

def scan_csv_clean(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "wide-csv")
    wide = Roles(spark, folder).wide_text()
    turned = wide.select(*sorted(wide.columns, key=lambda c: c[::-1]))
    csv.write_csv(turned, path, compression="gzip")
    return csv.clean_wide(csv.read_wide_csv(spark, path))


def scan_csv_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with fields too many or too few, and values with line breaks, are read and told apart."""
    wide = Roles(spark, folder).wide_text()
    broken = F.col("lap") == "1"
    paths = [scratch_path(spark, "wide-lines"), scratch_path(spark, "wide-broken")]
    seventh = F.col("resultId").cast("long") % 7

    def plant(line: Column) -> Column:
        return (
            F.when(seventh == 3, F.concat(line, F.lit(",more")))
            .when(seventh == 5, F.concat(line, F.lit(",,")))
            .when(seventh == 6, F.regexp_replace(line, ",[^,]*$", ""))
            .otherwise(line)
        )

    # a line is put together once, outside of whole-stage code: that many columns are too much for it
    line = F.concat_ws(",", *[F.col(f"`{c}`") for c in wide.columns])
    planted = F.transform(F.array(line), plant)[0]
    # one text column named as the header: its values are whole lines already
    lines = wide.where(~broken).select(planted.alias(",".join(wide.columns)))
    plain = {"header": True, "sep": "\u0001", "quote": "\u0000", "compression": "gzip"}
    lines.write.options(**plain).csv(paths[0])
    surname = F.regexp_replace("surname", " ", "\n")
    csv.write_csv(wide.where(broken).withColumn("surname", surname), paths[1], compression="gzip")
    rows = csv.read_wide_csv(spark, paths, multi_line=True)
    rejects = csv.wide_csv_rejects(spark, paths, multi_line=True)
    return rows.unionByName(rejects, allowMissingColumns=True)


def scan_json_docs(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "json-docs")
    documents.write_documents(docs.results_documents(Roles(spark, folder)), path)
    return _unplaced(flatten.flatten_results(documents.read_documents(spark, path)))


def scan_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Results asked for by season and round, out of a folder that stands for the public API."""
    path = scratch_path(spark, "pages")
    roles = Roles(spark, folder)
    # a round is a folder of its own: a request reads what it asks for and nothing else
    pages = docs.results_pages(roles)
    pages.repartition("season", "round").write.partitionBy("season", "round").parquet(path)
    ends = roles["raceDim"].agg(F.min("year"), F.max("year")).first()
    seasons = range(ends[0], ends[1] + 1)
    asked = read_requests(spark, _pages_in(path), seasons, 1, 366, rounds_per_task=ROUNDS)
    return _unplaced(flatten.flatten_results(asked))


def _pages_in(path: str) -> Callable[[int, int], list[str]]:
    def fetch(season: int, number: int) -> list[str]:
        store, root = FileSystem.from_uri(path)
        place = f"{root}/season={season}/round={number}"
        if store.get_file_info(place).type == FileType.NotFound:
            return []
        return dataset(place, filesystem=store, format="parquet").to_table(["value"])["value"].to_pylist()

    return fetch


def sink_json_records(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "json-records")
    roles = Roles(spark, folder)
    documents.write_records(_unplaced(flatten.flatten_results(docs.results_documents(roles))), path)
    required = ["round", "date", "driverId", "fastestLap"]
    records = documents.parse_records(documents.read_documents(spark, path), "result", required)
    return _unplaced(records)


def load_append(spark: SparkSession, folder: str) -> DataFrame:
    results = Roles(spark, folder)["raceResultsFact"]
    tables = StarTables(spark, scratch_path(spark, "star"))
    tables.append("raceResultsFact", results.where(F.col("raceId") <= SPLIT_RACE))
    tables.append("raceResultsFact", results.where(F.col("raceId") > SPLIT_RACE))
    return tables["raceResultsFact"]


def load_insert_ignore(spark: SparkSession, folder: str) -> DataFrame:
    results = Roles(spark, folder)["raceResultsFact"]
    tables = StarTables(spark, scratch_path(spark, "star"))
    tables.append("raceResultsFact", results.where(F.col("raceId") <= SPLIT_RACE))
    changed = results.withColumn("grid", F.lit(0))
    tables.append_new("raceResultsFact", changed, ["raceId", "driverId"])
    return tables["raceResultsFact"]


def null_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return csv.replace_null_tokens(Roles(spark, folder).wide_text())


def coerce_numeric(spark: SparkSession, folder: str) -> DataFrame:
    wide = Roles(spark, folder).wide_text()
    return csv.coerce_numeric(wide.select("_ord", *csv.COERCED_COLUMNS))


def drop_columns(spark: SparkSession, folder: str) -> DataFrame:
    return csv.drop_columns(Roles(spark, folder)["raceResultsFact"], ["grid", "laps", "time"])


def parse_date(spark: SparkSession, folder: str) -> DataFrame:
    wide = Roles(spark, folder).wide_text()
    days = ("dob", "date", "quali_date", "sprint_date")
    return wide.selectExpr("_ord", *[f"{to_day(c)} AS {c}" for c in days])


def ms_to_interval(spark: SparkSession, folder: str) -> DataFrame:
    laps = Roles(spark, folder)["lapsDim"].withColumn(
        "lap_time", millis_interval(F.col("milliseconds_laptimes"))
    )
    seconds = F.extract(F.lit("MINUTE"), "lap_time") * 60 + F.extract(F.lit("SECOND"), "lap_time")
    return laps.select("raceId", "driverId", "lap", seconds.cast("double").alias("lap_seconds"))


def first_order(spark: SparkSession, folder: str) -> DataFrame:
    results = Roles(spark, folder)["raceResultsFact"]
    return first_per_key(results, ["driverId"], ["raceId", "resultId"]).select(
        "driverId", "raceId", "resultId", "positionOrder"
    )


def distinct_rows(spark: SparkSession, folder: str) -> DataFrame:
    return distinct_project(Roles(spark, folder)["sprintDim"], ["raceId", "driverId", "sprint_date"])


def source_queries() -> dict[str, Query]:
    return {
        "scan_csv_clean": scan_csv_clean,
        "scan_csv_rejects": scan_csv_rejects,
        "scan_json_docs": scan_json_docs,
        "scan_requests": scan_requests,
        "sink_json_records": sink_json_records,
        "load_append": load_append,
        "load_insert_ignore": load_insert_ignore,
        "null_tokens": null_tokens,
        "coerce_numeric": coerce_numeric,
        "drop_columns": drop_columns,
        "parse_date": parse_date,
        "ms_to_interval": ms_to_interval,
        "first_per_key": first_order,
        "distinct_project": distinct_rows,
        "register_views": register_views,
    }


def digest_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count and an order-free digest of the rows of every table."""

    def text(name: str, kind: str) -> Column:
        value = F.floor(F.col(name) * 1000 + 0.5) if kind == "double" else F.col(name)
        return F.coalesce(value.cast("string"), F.lit("~"))

    parts = []
    for name, rows in tables.items():
        row = F.md5(F.concat_ws("|", *[text(c, kind) for c, kind in rows.dtypes]))
        number = F.conv(F.substring(row, 1, 8), 16, 10).cast("long")
        parts.append(
            rows.agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.sum(number).alias("digest"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


# -- star split -------------------------------------------------------------------------------

STAR_KEYS = {
    "star_driver": "driverDim",
    "star_constructor": "constructorDim",
    "star_circuit": "circuitDim",
    "star_status": "raceStatusDim",
    "star_race": "raceDim",
    "star_sprint": "sprintDim",
    "star_driver_standings": "driverStandingsDim",
    "star_constructor_standings": "constructorStandingsDim",
    "star_pit_stops": "pitStopsDim",
    "star_qualifying": "qualificationsDim",
    "star_practice": "freePracticeDim",
    "star_laps": "lapsDim",
    "star_results": "raceResultsFact",
}


def star_queries() -> dict[str, Query]:
    def one(table: str) -> Query:
        return lambda spark, folder: split_table(
            csv.clean_wide(Roles(spark, folder).wide_text()), table
        )

    def counts(spark: SparkSession, folder: str) -> DataFrame:
        return digest_rows(split_all(csv.clean_wide(Roles(spark, folder).wide_text())))

    return {**{key: one(table) for key, table in STAR_KEYS.items()}, "star_all_counts": counts}


# -- documents --------------------------------------------------------------------------------


def _unplaced(rows: DataFrame) -> DataFrame:
    """Rows without their arrival columns."""
    return rows.select(*[c for c in rows.columns if not c.startswith("_")])


def _on_documents(plan: Callable[[DataFrame], DataFrame], kind: str) -> Query:
    return lambda spark, folder: _unplaced(plan(docs.ALL[kind](Roles(spark, folder))))


def doc_counts(spark: SparkSession, folder: str) -> DataFrame:
    roles = Roles(spark, folder)
    counts = [
        flatten.document_counts(docs.ALL[kind](roles), kind).agg(
            F.lit(kind).alias("kind"),
            F.count(F.lit(1)).alias("document_count"),
            F.sum("item_count").alias("item_count"),
        )
        for kind in ("drivers", "circuits", "constructors")
    ]
    return reduce(DataFrame.unionByName, counts)


def doc_race_results(spark: SparkSession, folder: str) -> DataFrame:
    roles = Roles(spark, folder)
    found = flatten.results_for_calendar(
        docs.calendar_documents(roles), docs.results_documents(roles)
    )
    return found.withColumnRenamed("_seq", "document")


def doc_laps_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    laps = docs.flawed(docs.laps_documents(Roles(spark, folder)))
    return flatten.nonempty_lap_documents(laps).select(F.col("_seq").alias("document"))


def lap_requests(spark: SparkSession, folder: str) -> DataFrame:
    roles = Roles(spark, folder)
    totals = roles.read("lineitem").groupBy(F.col("l_orderkey").alias("_seq"))
    total = F.to_json(F.struct(F.struct(F.count("*").cast("string").alias("total")).alias("MRData")))
    requests = flatten.lap_requests(totals.agg(total.alias("value")))
    return requests.select(F.col("_seq").alias("document"), "lap")


def doc_validate(spark: SparkSession, folder: str) -> DataFrame:
    pits = docs.flawed(docs.pit_documents(Roles(spark, folder)))
    return flatten.document_report(pits, "races")


def document_queries() -> dict[str, Query]:
    return {
        "doc_counts": doc_counts,
        "doc_race_results": doc_race_results,
        "practice_session_count": _on_documents(flatten.practice_sessions, "races"),
        "doc_laps_nonempty": doc_laps_nonempty,
        "doc_lap_requests": lap_requests,
        "flatten_laps": _on_documents(flatten.flatten_laps, "laps"),
        "flatten_pit_stops": _on_documents(flatten.flatten_pit_stops, "pit_stops"),
        "flatten_pit_stops_lenient": _on_documents(
            lambda d: flatten.flatten_pit_stops(d, "lenient"), "pit_stops"
        ),
        "flatten_status": _on_documents(flatten.flatten_status, "status"),
        "flatten_driver_standings": _on_documents(
            flatten.flatten_driver_standings, "driver_standings"
        ),
        "flatten_constructor_standings": _on_documents(
            flatten.flatten_constructor_standings, "constructor_standings"
        ),
        "flatten_results": _on_documents(flatten.flatten_results, "results"),
        "doc_validate": doc_validate,
    }


# -- merges -----------------------------------------------------------------------------------


def loaded_before(roles: Roles) -> Mapping[str, DataFrame]:
    """The star as an earlier load left it; what is not cut here is complete."""
    early = F.col("raceId") <= SPLIT_RACE

    class Cut(dict):
        def __missing__(self, table: str) -> DataFrame:
            conditions = {
                "driverDim": F.col("nationality") < SPLIT_NATION,
                "constructorDim": F.col("nationality_constructors") < SPLIT_NATION,
                "circuitDim": F.col("country") < SPLIT_COUNTRY,
                "raceStatusDim": F.col("status") < "C",
                "raceDim": early,
                "freePracticeDim": early,
                "lapsDim": early,
                "pitStopsDim": early,
                "raceResultsFact": early,
                "driverStandingsDim": F.col("position_driverstandings") <= 10,
                "constructorStandingsDim": F.col("position_constructorstandings") <= 5,
            }
            return roles[table].where(conditions[table])

    return Cut()


def _merge(table: str, part: str = "new_rows") -> Query:
    """Merge the documents of a table into its earlier state; parents are complete.

    Except that the calendar does not know one region, and rejects are asked for with a status table
    from before.
    """

    def run(spark: SparkSession, folder: str) -> DataFrame:
        roles = Roles(spark, folder)
        load = LOADS[table]
        before = loaded_before(roles)
        known = {table: before[table]}
        if table == "raceDim":
            known["circuitDim"] = roles["circuitDim"].where("country <> 'ASIA'")
        if part == "rejects":
            known["raceStatusDim"] = before["raceStatusDim"]
        records = as_records(load.source, docs.ALL[load.source](roles))
        return getattr(load, part)(records, ChainMap(known, roles))

    return run


def merge_results_rejects(spark: SparkSession, folder: str) -> DataFrame:
    rejects = _merge("raceResultsFact", "rejects")(spark, folder)
    return rejects.groupBy(F.col("_reason").alias("reason")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def upsert_drivers(spark: SparkSession, folder: str) -> DataFrame:
    roles = Roles(spark, folder)
    updates = roles["driverDim"].withColumn("surname", F.concat("surname", F.lit(" II")))
    updates = updates.withColumn("_ord", F.col("driverId"))
    return upsert_by_key(loaded_before(roles)["driverDim"], updates, ["driverId"], "_ord")


def allocate(spark: SparkSession, folder: str) -> DataFrame:
    rows = Roles(spark, folder).read("orders").select("o_totalprice", "o_orderkey")
    return allocate_ids(rows, "new_id", ["o_totalprice", "o_orderkey"], start=100)


def _stored(spark: SparkSession, roles: Roles, names: list[str]) -> StarTables:
    tables = StarTables(spark, scratch_path(spark, "star"))
    before = loaded_before(roles)
    for name in names:
        tables.append(name, before[name])
    return tables


def merge_all_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every kind of document merged into a stored star, in load order."""
    roles = Roles(spark, folder)
    tables = _stored(spark, roles, list(LOADS))
    merge_all({kind: build(roles) for kind, build in docs.ALL.items()}, tables)
    return count_rows({name: tables[name] for name in LOADS})


def merge_constructor_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Teams under an old name are updated and keep their ids; unknown ones are added."""
    roles = Roles(spark, folder)
    tables = StarTables(spark, scratch_path(spark, "star"))
    before = loaded_before(roles)["constructorDim"]
    tables.append("constructorDim", before.withColumn("name", F.lit("Old name")))
    merge_all({"constructors": docs.ALL["constructors"](roles)}, tables, upsert=["constructorDim"])
    return tables["constructorDim"]


def merge_queries() -> dict[str, Query]:
    return {
        "merge_driver": _merge("driverDim"),
        "merge_circuit": _merge("circuitDim"),
        "merge_constructor": _merge("constructorDim"),
        "merge_race": _merge("raceDim"),
        "merge_practice": _merge("freePracticeDim"),
        "merge_laps": _merge("lapsDim"),
        "merge_pit_stops": _merge("pitStopsDim"),
        "merge_status": _merge("raceStatusDim"),
        "merge_driver_standings": _merge("driverStandingsDim"),
        "merge_constructor_standings": _merge("constructorStandingsDim"),
        "merge_results": _merge("raceResultsFact"),
        "merge_results_rejects": merge_results_rejects,
        "merge_audit": _merge("lapsDim", "audit"),
        "upsert_by_key": upsert_drivers,
        "allocate_ids": allocate,
        "merge_all_counts": merge_all_counts,
        "merge_constructor_upsert": merge_constructor_upsert,
    }


# -- streams ----------------------------------------------------------------------------------


def _land(spark: SparkSession, rows: DataFrame) -> str:
    """Documents as a folder of line files, the way a topic would deliver them."""
    path = scratch_path(spark, "landing")
    documents.write_documents(rows.repartition(8, "_seq"), path)
    return path


def _stream_kind(spark: SparkSession, roles: Roles, kind: str) -> DataFrame:
    """Documents of a kind landed and streamed, three files in eight a batch.

    However many there are, a file holds the work of one task, and it is landed compressed.
    """
    if kind not in docs.BY_ORDER:
        return stream_folder(spark, _land(spark, docs.ALL[kind](roles)), files_per_batch=3)
    path, files = scratch_path(spark, "landing"), roles.tasks(8)
    documents.write_documents(docs.landed(roles, kind, files), path, compression="gzip")
    return stream_folder(spark, path, files_per_batch=-(-3 * files // 8))


def stream_drain(spark: SparkSession, folder: str) -> DataFrame:
    """Pit stop documents read as a stream until it is drained, flattened and appended."""
    out = scratch_path(spark, "drained")
    records = flatten.flatten_pit_stops(_stream_kind(spark, Roles(spark, folder), "pit_stops"))
    append_stream(_unplaced(records), out, scratch_path(spark, "offsets")).awaitTermination()
    return spark.read.schema(_unplaced(records).schema).parquet(out)


def _stream_merge(table: str, parents: list[str]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        roles = Roles(spark, folder)
        tables = _stored(spark, roles, [table])
        for parent in parents:
            tables.append(parent, roles[parent])
        load = LOADS[table]
        merge_stream(
            _stream_kind(spark, roles, load.source),
            load,
            tables,
            scratch_path(spark, "offsets"),
        ).awaitTermination()
        return tables[table]

    return run


def stream_merge_driver(spark: SparkSession, folder: str) -> DataFrame:
    """Final drivers by reference; which new id a driver gets depends on file order."""
    drivers = _stream_merge("driverDim", [])(spark, folder)
    return drivers.groupBy("driverRef").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("driverId").alias("id_count")
    )


def stream_then_batch(spark: SparkSession, folder: str) -> DataFrame:
    """A stream, a one-off load and a stream from a new checkpoint, each with a part of the teams.

    Every writer keeps its own batches, so none of them replaces another's rows.
    """
    roles = Roles(spark, folder)
    tables = _stored(spark, roles, ["driverDim"])
    load = LOADS["driverDim"]
    parts = docs.ALL[load.source](roles).withColumn("_part", F.pmod(F.xxhash64("value"), F.lit(3)))

    def stream(part: int) -> None:
        landing = _land(spark, parts.where(F.col("_part") == part))
        source = stream_folder(spark, landing)
        merge_stream(source, load, tables, scratch_path(spark, "offsets")).awaitTermination()

    stream(0)
    merge_all({load.source: parts.where("_part = 1").select("value", "_seq")}, tables)
    stream(2)
    return tables["driverDim"].groupBy("driverRef").agg(
        F.count(F.lit(1)).alias("row_count"), F.countDistinct("driverId").alias("id_count")
    )


def stream_merge_all(spark: SparkSession, folder: str) -> DataFrame:
    """Every kind of document in one stream of mixed files, children as early as their parents."""
    roles = Roles(spark, folder)
    tables = _stored(spark, roles, list(LOADS))
    landing, files = scratch_path(spark, "landing"), roles.tasks(2)
    for kind in docs.ALL:
        write_messages(docs.landed(roles, kind, files), kind, landing, compression="gzip")
    # large kinds come before the last two, whose rows they miss, so a batch ends between them
    stream = stream_messages(spark, landing, files_per_batch=4 * (files + 1))
    merge_all_stream(stream, tables, scratch_path(spark, "offsets")).awaitTermination()
    return count_rows({name: tables[name] for name in LOADS})


def _record_stream(table: str, known: list[str]) -> Query:
    """New rows of a table out of its topic records, streamed."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        roles = Roles(spark, folder)
        load = LOADS[table]
        before = loaded_before(roles)[table]
        tables = _stored(spark, roles, [table])
        for parent in {lookup.parent for lookup in load.spec.lookups}:
            tables.append(parent, roles[parent])
        # files in arrival order, so that of two records with one key the same one stays
        arrived = docs.landed(roles, load.source, roles.tasks(8))
        records = as_records(load.source, arrived)
        path = scratch_path(spark, "landing")
        documents.write_records(records, path, compression="gzip")
        merge_stream(
            stream_folder(spark, path), load, tables, scratch_path(spark, "offsets"), form="record"
        ).awaitTermination()
        return tables[table].join(before.select(*known), known, "left_anti").select(*before.columns)

    return run


def stream_merge_laps(spark: SparkSession, folder: str) -> DataFrame:
    """Final laps per race; of two laps with one key, file order decides which stays."""
    laps = _stream_merge("lapsDim", ["raceDim", "driverDim"])(spark, folder)
    return laps.groupBy("raceId").agg(F.count(F.lit(1)).alias("lap_count"))


def stream_queries() -> dict[str, Query]:
    return {
        "stream_drain": stream_drain,
        "stream_merge_driver": stream_merge_driver,
        "stream_merge_laps": stream_merge_laps,
        "stream_merge_all": stream_merge_all,
        "stream_then_batch": stream_then_batch,
        "stream_merge_pit_records": _record_stream("pitStopsDim", ["raceId", "driverId", "stop"]),
        "stream_merge_status_records": _record_stream("raceStatusDim", ["status"]),
        "stream_merge_results_records": _record_stream("raceResultsFact", ["resultId"]),
    }


# -- profiling and checks ---------------------------------------------------------------------


def _on_table(plan: Callable[..., DataFrame], table: str, *args, **kwargs) -> Query:
    return lambda spark, folder: plan(Roles(spark, folder)[table], *args, **kwargs)


def profile_queries() -> dict[str, Query]:
    results = "raceResultsFact"
    return {
        "profile_sample": _on_table(profile.sample_rows, results, ["resultId"]),
        "profile_shape": _on_table(profile.shape, "lapsDim"),
        "profile_minmax": _on_table(profile.min_max, "raceDim", "year"),
        "profile_dup_key": _on_table(profile.has_duplicate_key, results, "driverId"),
        "profile_dup_rows": _on_table(profile.duplicate_row_count, "sprintDim"),
        "profile_nulls": _on_table(profile.any_nulls, results),
        "profile_mismatch": _on_table(
            profile.mismatch_mask, results, ["resultId"], "positionOrder", "grid"
        ),
        "profile_top_values": _on_table(profile.top_values, results, "driverId"),
        "profile_distinct": _on_table(profile.distinct_values, "raceDim", "circuitId"),
        "profile_col_equal": _on_table(
            profile.columns_equal, results, "constructorStandingsId", "driverStandingsId"
        ),
        "check_pk": _on_roles(check_primary_keys),
        "check_fk": _on_roles(check_references),
    }


def all_queries() -> dict[str, Query]:
    return {
        **view_queries(),
        **source_queries(),
        **star_queries(),
        **document_queries(),
        **merge_queries(),
        **stream_queries(),
        **profile_queries(),
    }


