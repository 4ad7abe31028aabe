"""Contiguous surrogate ids without a one-task window."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a task in its low 33 bits


def highest_id(target: DataFrame, id_column: str) -> int:
    """``coalesce(max(id), 0)`` of a table: one number, from partial maxima."""
    return target.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("top")).first()["top"]


def allocate_ids(
    rows: DataFrame,
    id_column: str,
    order_by: Sequence[str],
    start: int | Callable[[int], int] = 0,
) -> DataFrame:
    """Add ``id_column`` = ``start`` + position of the row in ``order_by`` order, from 1.

    ``start`` may be a function of the number of rows, such as one that leases as many ids.

    One range shuffle puts the rows in order over all tasks. Each row's task and place in it are
    staged, so the boundaries are drawn once. The only step on one task is the running sum over
    the per-task counts, one row per shuffle partition.
    """
    ordered = (
        rows.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    staged = stage(ordered, "ids").withColumn("_slot", F.shiftright("_place", _ROW_BITS))
    if callable(start):
        start = start(staged.count())  # the row counts of the staged files
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy("_slot")
        .count()
        .select(
            "_slot",
            F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"),
        )
    )
    place_in_slot = F.col("_place").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        # at most one row per shuffle partition
        staged.join(F.broadcast(offsets), "_slot")
        .withColumn(id_column, F.lit(start) + F.col("_offset") + place_in_slot + 1)
        .drop("_place", "_slot", "_offset")
    )
