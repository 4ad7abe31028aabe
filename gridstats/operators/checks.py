"""Key and reference checks over the star tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import PRIMARY_KEYS, REFERENCES


def check_primary_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per keyed table: rows without a key, and key values that occur more than once."""
    return reduce(DataFrame.unionByName, (key_report(tables[t], t, k) for t, k in PRIMARY_KEYS.items()))


def key_report(df: DataFrame, table: str, key: str) -> DataFrame:
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    is_null = F.col(key).isNull()
    return groups.agg(
        F.lit(table).alias("table_name"),
        F.coalesce(F.sum(F.when(is_null, F.col("_n"))), F.lit(0)).cast("long").alias("null_keys"),
        F.count(F.when(~is_null & (F.col("_n") > 1), 1)).alias("duplicate_keys"),
    )


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """The offending key values with their row counts."""
    groups = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return groups.where((F.col("row_count") > 1) | F.col(key).isNull())


def check_references(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per declared reference: child rows and distinct child values without a parent.

    A child table is read once: its reference columns are stacked and counted per value.
    """
    children: dict[str, list[tuple[str, str, str]]] = {}
    for child, column, parent, parent_column in REFERENCES:
        children.setdefault(child, []).append((column, parent, parent_column))
    return reduce(
        DataFrame.unionByName, (_child_report(tables, c, refs) for c, refs in children.items())
    )


def _child_report(
    tables: Mapping[str, DataFrame], child: str, refs: list[tuple[str, str, str]]
) -> DataFrame:
    cells = [
        F.struct(F.lit(i).alias("ref"), F.col(column).cast("string").alias("value"))
        for i, (column, _, _) in enumerate(refs)
    ]
    values = (
        tables[child]
        .select(F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull())
        .groupBy("ref", "value")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = reduce(
        DataFrame.unionByName,
        (
            tables[parent]
            .select(F.lit(i).alias("ref"), F.col(column).cast("string").alias("value"))
            .distinct()
            for i, (_, parent, column) in enumerate(refs)
        ),
    )
    lost = values.join(known, ["ref", "value"], "left_anti").groupBy("ref").agg(
        F.sum("row_count").alias("rows"), F.count(F.lit(1)).alias("values")
    )
    spark = values.sparkSession
    names = spark.createDataFrame(
        [(i, column, parent) for i, (column, parent, _) in enumerate(refs)],
        "ref int, child_column string, parent_table string",
    )
    return names.join(lost, "ref", "left").select(
        F.lit(child).alias("child_table"),
        "child_column",
        "parent_table",
        F.coalesce("rows", F.lit(0)).cast("long").alias("orphan_rows"),
        F.coalesce("values", F.lit(0)).cast("long").alias("orphan_values"),
    )


def orphans(
    tables: Mapping[str, DataFrame], child: str, column: str, parent: str, parent_column: str
) -> DataFrame:
    """Child values without a parent, with their row counts; a null refers to nothing.

    The child is counted per value before the join, so a value on most rows is one row there.
    """
    values = (
        tables[child]
        .where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = tables[parent].select(F.col(parent_column).alias("value")).distinct()
    return values.join(known, "value", "left_anti")


def orphan_report(
    tables: Mapping[str, DataFrame], child: str, column: str, parent: str, parent_column: str
) -> DataFrame:
    return orphans(tables, child, column, parent, parent_column).agg(
        F.lit(child).alias("child_table"),
        F.lit(column).alias("child_column"),
        F.lit(parent).alias("parent_table"),
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("long").alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_values"),
    )
