"""The wide results file split into the thirteen star tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.dedupe import distinct_project, first_per_key
from ..operators.merge import REASON
from ..schemas import ORDER_COLUMN, PRIMARY_KEYS, TABLES
from ..session import stage, stage_by, temporary_stages
from ..sources.tables import StarTables

# Tables that keep the first row of each id, in file order; all others keep distinct rows.
_FIRST_BY = {
    "driverDim": "driverId",
    "circuitDim": "circuitId",
    "raceStatusDim": "statusId",
    "raceDim": "raceId",
}

SHARED_KEY = ("raceId", "driverId")

# Parents before the tables that refer to them.
LOAD_ORDER = (
    "constructorDim",
    "driverDim",
    "circuitDim",
    "constructorStandingsDim",
    "driverStandingsDim",
    "raceDim",
    "sprintDim",
    "freePracticeDim",
    "pitStopsDim",
    "qualificationsDim",
    "lapsDim",
    "raceStatusDim",
    "raceResultsFact",
)


def split_table(wide: DataFrame, table: str) -> DataFrame:
    """One star table out of the cleaned wide file; reads only that table's columns."""
    columns = [f.name for f in TABLES[table]]
    key = _FIRST_BY.get(table)
    if key is None:
        return distinct_project(wide, columns)
    return first_per_key(wide.select(ORDER_COLUMN, *columns), [key], [ORDER_COLUMN]).select(
        *columns
    )


def split_all(wide: DataFrame) -> dict[str, DataFrame]:
    """All thirteen tables over one staged copy of the cleaned file.

    The cleaned file is written once as Parquet, so every table reads its own columns of it and
    none parses the text again. It lies in buckets of race and driver, and the five tables that hold
    both keep their distinct rows there, without a shuffle of their own.
    """
    staged = stage_by(wide, "wide", list(SHARED_KEY))
    return {table: split_table(staged, table) for table in LOAD_ORDER}


def load_star(
    wide: DataFrame,
    tables: StarTables,
    on_loaded: Callable[[str, int], None] | None = None,
    batch: int | None = None,
) -> None:
    """Split the cleaned file and append it to the stored star, parents first.

    Keyed tables take only rows whose id is new; of several rows with one id the first of the file
    stays, and the others are kept as rejects. ``batch`` numbers the load: a repeated load with the
    same number replaces its rows, in every table.
    """
    with temporary_stages(tables.spark):
        staged = stage_by(wide, "wide", list(SHARED_KEY))
        for table in LOAD_ORDER:
            columns = [f.name for f in TABLES[table]]
            number = tables.last_batch(table) + 1 if batch is None else batch
            if table in PRIMARY_KEYS:
                key = PRIMARY_KEYS[table]
                # distinct rows, each with its first place in the file
                rows = staged.groupBy(*columns).agg(F.min(ORDER_COLUMN).alias(ORDER_COLUMN))
                known = tables.before(table, number).select(F.col(key).alias("_known"))
                fresh = rows.join(known, F.col(key) == F.col("_known"), "left_anti")
                per_id = Window.partitionBy(key, F.when(F.col(key).isNull(), F.col(ORDER_COLUMN)))
                place = F.row_number().over(per_id.orderBy(ORDER_COLUMN))
                placed = stage(fresh.withColumn("_place", place), "placed")
                tables.append(table, placed.where("_place = 1"), number)
                drifting = placed.where("_place > 1").select(*columns)
                drifting.withColumn(REASON, F.lit("repeated_id")).write.mode("overwrite").parquet(
                    tables.place(f"_rejects/{table}", number)
                )
            else:
                tables.append(table, split_table(staged, table), number)
            if on_loaded:
                on_loaded(table, number)
