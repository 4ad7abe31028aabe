"""Documents and records merged into the star tables.

Each load is a :class:`~gridstats.operators.merge.MergeSpec` and a function that turns documents or
records into rows named like the target; ``merge_new`` does the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Container, Mapping
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.times import is_minute_text, lap_millis
from ..operators.merge import (
    REASON,
    Lookup,
    MergeSpec,
    attach_parents,
    merge_audit,
    merge_new,
    merge_rejects,
    merge_upsert,
)
from ..schemas import TABLES
from ..session import TEXTS, stage, temporary_stages
from ..sources.documents import (
    SEQ,
    document_faults,
    parse_documents,
    parse_records,
    validate_documents,
)
from ..sources.tables import ONE_OFF, StarTables, path_exists
from . import flatten


@dataclass(frozen=True)
class Load:
    """One table's load: which documents feed it, how they become rows, how rows are merged."""

    source: str
    spec: MergeSpec
    rows: Callable[..., DataFrame]

    def incoming(self, docs: DataFrame, mode: str = "reference") -> DataFrame:
        return self.rows(docs, mode)

    def merge(self, incoming: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
        """The rows to append, out of incoming rows."""
        return merge_new(incoming, tables[self.spec.table], self.spec, tables)

    def misses(self, incoming: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
        """The incoming rows that miss a parent or a required value, with the reason."""
        return merge_rejects(incoming, self.spec, tables)

    def new_rows(
        self, docs: DataFrame, tables: Mapping[str, DataFrame], mode: str = "reference"
    ) -> DataFrame:
        return self.merge(self.rows(docs, mode), tables)

    def rejects(
        self, docs: DataFrame, tables: Mapping[str, DataFrame], mode: str = "reference"
    ) -> DataFrame:
        return self.misses(self.rows(docs, mode), tables)

    def audit(
        self, docs: DataFrame, tables: Mapping[str, DataFrame], mode: str = "reference"
    ) -> DataFrame:
        """Row counts by outcome."""
        return merge_audit(self.rows(docs, mode), tables[self.spec.table], self.spec, tables)


def _columns(table: str) -> tuple[str, ...]:
    return tuple(f.name for f in TABLES[table])


def _first_null_only(items: str, key: str):
    """Of the elements without a key, only the first of a document counts."""
    nulls = F.transform(items, lambda item: item[key].isNull())
    return F.array_position(nulls, True) - 1


# -- documents or records -> rows -------------------------------------------------------------


def _drivers(docs: DataFrame, mode: str) -> DataFrame:
    items = f"doc.{flatten.LISTS['drivers']}"
    parsed = parse_documents(docs, "drivers").withColumn("_n", _first_null_only(items, "driverId"))
    rows = parsed.select(SEQ, "_n", F.posexplode(items).alias("_pos", "d"))
    rows = rows.where(F.col("d.driverId").isNotNull() | (F.col("_pos") == F.col("_n")))
    renamed = rows.select(SEQ, "_pos", "d.*").withColumnsRenamed(
        {
            "driverId": "driverRef",
            "givenName": "forename",
            "familyName": "surname",
            "permanentNumber": "number",
            "dateOfBirth": "dob",
        }
    )
    return renamed.withColumn("dob", F.col("dob").try_cast("date")).withColumn(
        "number", F.col("number").try_cast("int")
    )


def _constructors(docs: DataFrame, mode: str) -> DataFrame:
    items = f"doc.{flatten.LISTS['constructors']}"
    parsed = parse_documents(docs, "constructors").withColumn(
        "_n", _first_null_only(items, "constructorId")
    )
    rows = parsed.select(SEQ, "_n", F.posexplode(items).alias("_pos", "c"))
    rows = rows.where(F.col("c.constructorId").isNotNull() | (F.col("_pos") == F.col("_n")))
    return rows.select(SEQ, "_pos", "c.*").withColumnsRenamed(
        {
            "constructorId": "constructorRef",
            "nationality": "nationality_constructors",
            "url": "url_constructors",
        }
    )


def _circuits(docs: DataFrame, mode: str) -> DataFrame:
    parsed = parse_documents(docs, "circuits")
    rows = parsed.select(SEQ, F.posexplode(f"doc.{flatten.LISTS['circuits']}").alias("_pos", "c"))
    country, place = F.col("c.Location.country"), F.col("c.Location.locality")
    complete = (F.coalesce(country, F.lit("")) != "") & (F.coalesce(place, F.lit("")) != "")
    return rows.select(
        SEQ,
        "_pos",
        F.col("c.circuitId").alias("circuitRef"),
        F.col("c.circuitName").alias("name_y"),
        place.alias("location"),
        country.alias("country"),
        F.col("c.Location.lat").try_cast("double").alias("lat"),
        F.col("c.Location.long").try_cast("double").alias("lng"),
        F.lit(None).cast("double").alias("alt"),
        F.col("c.url").alias("url_y"),
        F.when(~complete, F.lit("incomplete")).alias(REASON),
    )


def _races(docs: DataFrame, mode: str) -> DataFrame:
    return flatten.calendar(docs).select(
        SEQ,
        "_pos",
        F.col("race.Circuit.circuitId").alias("circuitRef"),
        F.col("race.raceName").alias("name_x"),
        F.col("race.date").try_cast("date").alias("date"),
        F.col("race.season").try_cast("int").alias("year"),
        F.col("race.round").try_cast("int").alias("round"),
        F.col("race.time").alias("time_races"),
        F.col("race.url").alias("url_x"),
    )


def _practice(docs: DataFrame, mode: str) -> DataFrame:
    """``reference`` lets the first document of a date win even when it lists no session;
    ``lenient`` puts documents with sessions first."""
    rows = flatten.calendar(docs)
    sessions = {"fp1": "FirstPractice", "fp2": "SecondPractice", "fp3": "ThirdPractice"}
    columns = []
    for short, name in sessions.items():
        columns.append(F.col(f"race.{name}.date").try_cast("date").alias(f"{short}_date"))
        columns.append(F.col(f"race.{name}.time").alias(f"{short}_time"))
    listed = F.coalesce(*[F.col(f"race.{name}.date") for name in sessions.values()]).isNotNull()
    late = ~listed if mode == "lenient" else F.lit(False)
    return rows.select(
        SEQ,
        "_pos",
        late.alias("_late"),
        F.col("race.date").try_cast("date").alias("date"),
        *columns,
    )


def _laps(docs: DataFrame, mode: str) -> DataFrame:
    text = F.col("time")
    return flatten.flatten_laps(docs).select(
        SEQ,
        "_pos",
        "_pos2",
        "_pos3",
        F.col("date").try_cast("date").alias("date"),
        F.col("driverId").alias("driverRef"),
        F.col("lap").try_cast("int").alias("lap"),
        text.alias("time_laptimes"),
        lap_millis(text, mode).alias("milliseconds_laptimes"),
        F.col("position").try_cast("int").alias("position_laptimes"),
        F.when(~is_minute_text(text), F.lit("bad_time")).alias(REASON),
    )


def _pit_stops(records: DataFrame, mode: str) -> DataFrame:
    return records.select(
        *_order_columns(records),
        F.col("season").try_cast("int").alias("year"),
        F.col("round").try_cast("int").alias("round"),
        F.col("driverId").alias("driverRef"),
        "stop",
        "lap_pitstops",
        "time_pitstops",
        "duration",
        *_reason_column(records),
    )


def _statuses(records: DataFrame, mode: str) -> DataFrame:
    return records.select(*_order_columns(records), "status", *_reason_column(records))


def _driver_standings(docs: DataFrame, mode: str) -> DataFrame:
    return flatten.flatten_driver_standings(docs).withColumnsRenamed(
        {
            "driverId": "driverRef",
            "position": "position_driverstandings",
            "points": "points_driverstandings",
        }
    )


def _constructor_standings(docs: DataFrame, mode: str) -> DataFrame:
    return flatten.flatten_constructor_standings(docs).withColumnsRenamed(
        {
            "constructorId": "constructorRef",
            "position": "position_constructorstandings",
            "points": "points_constructorstandings",
            "wins": "wins_constructorstandings",
        }
    )


def _results(records: DataFrame, mode: str) -> DataFrame:
    missing_round = F.when(F.col("round").isNull(), F.lit("missing_round"))
    earlier = F.col(REASON) if REASON in records.columns else F.lit(None).cast("string")
    return records.select(
        *_order_columns(records),
        F.col("round").try_cast("int").alias("round"),
        F.col("date").try_cast("date").alias("date"),
        F.col("constructorId").alias("constructorRef"),
        F.col("driverId").alias("driverRef"),
        F.col("statusId").alias("status"),
        F.col("positionOrder").try_cast("int").alias("positionOrder"),
        "points",
        "laps",
        "grid",
        "fastestLapTime",
        "fastestLapSpeed",
        "time",
        "fastestLap",
        F.coalesce(earlier, missing_round).alias(REASON),
    )


def _order_columns(records: DataFrame) -> list[str]:
    return [c for c in records.columns if c == SEQ or c.startswith("_pos")]


def _reason_column(records: DataFrame) -> list[str]:
    return [REASON] if REASON in records.columns else []


# -- the loads --------------------------------------------------------------------------------

_CIRCUIT = Lookup(
    "circuitDim", {"circuitRef": "circuitRef"}, "circuitId", "circuitId", "missing_circuit"
)
_RACE_BY_DATE = Lookup("raceDim", {"date": "date"}, "raceId", "raceId", "missing_race")
_RACE_BY_ROUND = Lookup(
    "raceDim", {"year": "year", "round": "round"}, "raceId", "raceId", "missing_race"
)
_RACE_BY_BOTH = Lookup(
    "raceDim", {"round": "round", "date": "date"}, "raceId", "raceId", "missing_race"
)
_DRIVER = Lookup(
    "driverDim", {"driverRef": "driverRef"}, "driverId", "driverId", "missing_driver"
)
_CONSTRUCTOR = Lookup(
    "constructorDim",
    {"constructorRef": "constructorRef"},
    "constructorId",
    "constructorId",
    "missing_constructor",
)
_STATUS = Lookup("raceStatusDim", {"status": "status"}, "statusId", "statusId", "missing_status")


def _any_standings(pick: str) -> tuple[Lookup, Lookup]:
    return (
        Lookup(
            "constructorStandingsDim",
            {"constructorId": "constructorId"},
            "constructorStandingsId",
            "constructorStandingsId",
            "missing_constructor_standings",
            pick,
        ),
        Lookup(
            "driverStandingsDim",
            {"driverId": "driverId"},
            "driverStandingsId",
            "driverStandingsId",
            "missing_driver_standings",
            pick,
        ),
    )


def _load(source: str, table: str, rows: Callable, order: int = 1, **spec) -> Load:
    """``order`` is the number of position columns below the document."""
    places = (SEQ, *["_pos" if i == 0 else f"_pos{i + 1}" for i in range(order)])
    settings = {"order_by": places, **spec}
    return Load(source, MergeSpec(table=table, columns=_columns(table), **settings), rows)


def results_load(pick: str = "min", order: int = 2, key: tuple[str, ...] = ()) -> Load:
    """Results take the standings rows with the lowest (or highest) id of their team and driver.

    By default every record is a new row; give ``key`` to skip results that are there already.
    """
    lookups = (_RACE_BY_BOTH, _STATUS, _CONSTRUCTOR, _DRIVER, *_any_standings(pick))
    return _load(
        "results",
        "raceResultsFact",
        _results,
        order,
        lookups=lookups,
        id_column="resultId",
        key=key,
    )


def driver_standings_load(key: tuple[str, ...] = ()) -> Load:
    """By default every record is a new row; give ``key`` to skip rows that are there already."""
    return _load(
        "driver_standings",
        "driverStandingsDim",
        _driver_standings,
        lookups=(_DRIVER,),
        id_column="driverStandingsId",
        key=key,
    )


# In load order: every table after the ones it looks things up in.
LOADS: dict[str, Load] = {
    "raceStatusDim": _load(
        "status", "raceStatusDim", _statuses, key=("status",), id_column="statusId"
    ),
    "constructorDim": _load(
        "constructors",
        "constructorDim",
        _constructors,
        key=("constructorRef",),
        id_column="constructorId",
    ),
    "circuitDim": _load(
        "circuits", "circuitDim", _circuits, key=("circuitRef",), id_column="circuitId"
    ),
    "driverDim": _load("drivers", "driverDim", _drivers, key=("driverRef",), id_column="driverId"),
    "raceDim": _load(
        "races", "raceDim", _races, key=("date",), lookups=(_CIRCUIT,), id_column="raceId"
    ),
    "freePracticeDim": _load(
        "races",
        "freePracticeDim",
        _practice,
        key=("raceId",),
        lookups=(_RACE_BY_DATE,),
        order_by=("_late", SEQ, "_pos"),
    ),
    "lapsDim": _load(
        "laps",
        "lapsDim",
        _laps,
        3,
        key=("raceId", "driverId", "lap"),
        lookups=(_RACE_BY_DATE, _DRIVER),
    ),
    "pitStopsDim": _load(
        "pit_stops",
        "pitStopsDim",
        _pit_stops,
        2,
        key=("raceId", "driverId", "stop"),
        lookups=(_RACE_BY_ROUND, _DRIVER),
    ),
    "driverStandingsDim": driver_standings_load(),
    "constructorStandingsDim": _load(
        "constructor_standings",
        "constructorStandingsDim",
        _constructor_standings,
        lookups=(_CONSTRUCTOR,),
        id_column="constructorStandingsId",
        key=(
            "constructorId",
            "position_constructorstandings",
            "points_constructorstandings",
            "wins_constructorstandings",
        ),
    ),
    "raceResultsFact": results_load(),
}


# Sources that also come as flat topic records, their kind and required keys.
RECORDS = {
    "pit_stops": (
        "pit_stop",
        ("season", "round", "driverId", "stop", "lap_pitstops", "time_pitstops", "duration"),
    ),
    "status": ("status", ("status",)),
    "results": ("result", ("round",)),
}


def as_records(
    source: str, docs: DataFrame, mode: str = "reference", form: str = "document"
) -> DataFrame:
    """Input in the form its load reads: pit stops, statuses and results are records.

    With ``form="record"`` the input holds flat topic records already, one per row; one without a
    required key is kept with the reason ``missing_keys``.
    """
    if form == "record":
        if source not in RECORDS:
            raise ValueError(f"{source} comes as documents only, not as records")
        kind, required = RECORDS[source]
        places = {"_pos": F.lit(0), "_pos2": F.lit(0)}
        return parse_records(docs, kind, required).withColumns(places)
    flattened = {
        "pit_stops": lambda d: flatten.flatten_pit_stops(d, mode),
        "status": flatten.flatten_status,
        "results": flatten.flatten_results,
    }
    return flattened[source](docs) if source in flattened else docs


def _faults(load: Load, docs: DataFrame, form: str) -> DataFrame:
    """Documents that give no rows because they are malformed or lack their list."""
    if form == "record":  # a record that cannot be read is a rejected row
        return docs.select("value", F.lit("").alias(REASON)).limit(0)
    return document_faults(docs, flatten.PATHS[load.source]).select("value", REASON)


def merge_batch(
    load: Load,
    docs: DataFrame,
    tables: StarTables,
    batch: int,
    writer: str = ONE_OFF,
    mode: str = "reference",
    form: str = "document",
    strict: bool = False,
    waiting: DataFrame | None = None,
    upsert: bool = False,
) -> None:
    """Merge one batch of input into its table, and keep what could not be loaded.

    Of the table only the buckets are read that the batch's keys fall in, and new ids are leased
    from its manifest, so neither grows with what is stored, and two loads may run at once. With
    ``upsert`` known keys take the new values and keep their ids: the buckets they lie in are
    written anew.

    Beside the table, under the same writer and number, lie its rejected rows (``_rejects``), its
    documents that gave no rows (``_faults``) and its row counts by outcome (``_audit``). All of
    them depend only on the batch and on what was there before it, and replace what an earlier
    attempt left. The counts are taken while the rows, the rejects and the faults are written; a job
    of its own runs only for rows whose key the table knew, and for reasons where there are some.
    ``strict`` fails at the first faulty document instead.
    """
    table, spec = load.spec.table, load.spec
    if upsert and not spec.key:
        raise ValueError(f"{table} has no natural key to update by")
    if strict and form == "document":
        # the filter keeps the check in the plan
        checked = validate_documents(docs, flatten.PATHS[load.source], strict=True)
        docs = checked.where(F.col(REASON).isNull()).drop(REASON)
    incoming = load.incoming(as_records(load.source, docs, mode, form), mode)
    if REASON not in incoming.columns:
        incoming = incoming.withColumn(REASON, F.lit(None).cast("string"))
    if waiting is not None:
        again = waiting.withColumn(REASON, F.lit(None).cast("string"))
        incoming = incoming.unionByName(again.select(*incoming.columns))
    with temporary_stages(tables.spark):
        # parents are looked up once, for the rows, the rejects and the counts. Staged, the arrival
        # places, which repeat a file's name in every row, take next to no room.
        seen = Observation()
        counted = attach_parents(incoming, spec, tables).observe(
            seen, F.count_if(F.col(REASON).isNull()).alias("valid")
        )
        found = stage(counted, "found", compression="zstd")
        alone = replace(spec, lookups=())
        keys = found.where(F.col(REASON).isNull()).select(*spec.key) if spec.key else None
        before = tables.before(table, batch, writer, keys)

        def lease(count: int) -> int:
            return tables.manifest(table).lease_ids(writer, batch, count)

        if upsert:
            tables.rewrite(
                table, spec.key, keys, lambda t: merge_upsert(found, t, alone, lease), batch, writer
            )
        else:
            rows = merge_new(found, before, alone, start=lease)
            tables.write_batch(table, rows, batch, writer, spec.key)
        misses = found.where(F.col(REASON).isNotNull()).select(*incoming.columns)
        lost = _write_counted(misses, tables.place(f"_rejects/{table}", batch, writer))
        faulty = _write_counted(_faults(load, docs, form), tables.place(f"_faults/{table}", batch, writer))
        if upsert:
            audit = merge_audit(found.where(F.col(REASON).isNull()), before, alone).collect()
            outcomes = {r["outcome"].replace("exists", "updated"): r["row_count"] for r in audit}
        else:
            inserted = tables.rows_in(table, batch, writer)
            outcomes = _outcomes(found, before, spec, seen.get["valid"], inserted)
        for reason, count in [*lost.items(), *faulty.items()]:
            outcomes[reason] = outcomes.get(reason, 0) + count
        _audit_rows(tables.spark, table, outcomes).write.mode("overwrite").parquet(
            tables.place(f"_audit/{table}", batch, writer)
        )
    tables.settle(table, writer, batch)


_AUDIT = "table_name string, outcome string, row_count long"


def _write_counted(rows: DataFrame, path: str) -> dict[str, int]:
    """Write rejected rows and count them by reason; without any, that takes no further job."""
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    if not seen.get["n"]:
        return {}
    stored = rows.sparkSession.read.parquet(path).groupBy(REASON).count()
    return {r[REASON]: r["count"] for r in stored.collect()}


def _outcomes(
    found: DataFrame, before: DataFrame, spec: MergeSpec, valid: int, inserted: int
) -> dict[str, int]:
    """What became of the valid rows: those with a known key are looked up only if some were left out.

    The same numbers as ``merge_audit`` over the batch and the table as it was before.
    """
    exists = 0
    if valid > inserted:
        keys = found.where(F.col(REASON).isNull()).select(*spec.key)
        exists = keys.join(before.select(*spec.key), list(spec.key), "left_semi").count()
    return {"exists": exists, "inserted": inserted, "repeated": valid - inserted - exists}


def _audit_rows(spark: SparkSession, table: str, outcomes: Mapping[str, int]) -> DataFrame:
    rows = [(table, outcome, count) for outcome, count in outcomes.items() if count]
    if not rows:
        return spark.createDataFrame([], _AUDIT).coalesce(1)
    # one row per outcome, made of literals: no Python worker is started for them
    listed = F.array(*[F.struct(*[F.lit(v) for v in row]) for row in rows])
    named = listed.cast("array<struct<table_name: string, outcome: string, row_count: bigint>>")
    return spark.range(1, numPartitions=1).select(F.inline(named))


def audit_of(tables: StarTables) -> DataFrame:
    """Row counts of all stored batches as (table_name, outcome, row_count)."""
    spark = tables.spark
    parts = [
        spark.read.schema(_AUDIT).option("recursiveFileLookup", True).parquet(path)
        for path in (f"{tables.root}/_audit/{t}" for t in TABLES)
        if path_exists(spark, path)
    ]
    if not parts:
        return spark.createDataFrame([], _AUDIT)
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy("table_name", "outcome").agg(F.sum("row_count").alias("row_count"))


def retry_rejects(
    load: Load, tables: StarTables, batch: int, writer: str = ONE_OFF, mode: str = "reference"
) -> None:
    """Try a batch's rows again that missed a parent, without waiting for new input.

    They are merged as the writer's next batch, and what still misses a parent is rejected there.
    """
    waiting = waiting_rejects(load, tables, batch, writer)
    if waiting is None:
        return
    empty = tables.spark.createDataFrame([], f"value string, {SEQ} {_seq_type(waiting)}")
    form = "record" if load.source in RECORDS else "document"
    merge_batch(load, empty, tables, batch + 1, writer, mode, form, waiting=waiting)


def _seq_type(rows: DataFrame) -> str:
    return rows.schema[SEQ].dataType.simpleString()


def waiting_rejects(
    load: Load, tables: StarTables, batch: int, writer: str
) -> DataFrame | None:
    """The rejected rows of a batch that a later parent could still let in."""
    path = tables.place(f"_rejects/{load.spec.table}", batch, writer)
    if not path_exists(tables.spark, path):
        return None
    reasons = [lookup.reason for lookup in load.spec.lookups]
    return tables.spark.read.parquet(path).where(F.col(REASON).isin(*reasons))


def merge_all(
    documents: Mapping[str, DataFrame],
    tables: StarTables,
    mode: str = "reference",
    forms: Mapping[str, str] | None = None,
    batch: int | None = None,
    strict: bool = False,
    upsert: Container[str] = (),
) -> dict[str, int]:
    """Merge documents of every kind into the stored star, in load order.

    ``upsert`` names the tables whose known rows are updated. Returns the batch number each table was written under; ``batch`` states it, so that a repeated
    run replaces its rows. ``forms`` names the sources that come as topic records. Each table is
    stored before the next load looks things up in it; rejects and counts are kept (``audit_of``).
    """
    batches = {}
    for table, load in LOADS.items():
        if load.source not in documents:
            continue
        number = tables.last_batch(table) + 1 if batch is None else batch
        form = (forms or {}).get(load.source, "document")
        with temporary_stages(tables.spark):
            # read for the rows and for the faults: what the documents come from is done once
            docs = stage(documents[load.source], "documents", **TEXTS)
            merge_batch(
                load,
                docs,
                tables,
                number,
                mode=mode,
                form=form,
                strict=strict,
                upsert=table in upsert,
            )
        batches[table] = number
    return batches
