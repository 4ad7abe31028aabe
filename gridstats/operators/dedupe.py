"""Keeping one row per key, and one copy of equal rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str | Column],
    null_keys_match: bool = True,
) -> DataFrame:
    """The first row of every key in ``order_by`` order.

    Spark plans a group limit below the shuffle for ``row_number() = 1``, so each map task sends
    one row per key and a key that holds most of the input costs no more than any other.

    With ``null_keys_match=False`` a key with a null part equals nothing, so all such rows stay;
    they are spread by their order columns (given by name).
    """
    partition = [F.col(c) for c in key]
    if not null_keys_match:
        has_null = F.lit(False)
        for column in partition:
            has_null = has_null | column.isNull()
        partition.append(F.when(has_null, F.struct(*order_by)))
    order = [c if isinstance(c, Column) else F.col(c).asc_nulls_last() for c in order_by]
    window = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def distinct_project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of some columns; nulls equal each other."""
    return df.select(*columns).distinct()
