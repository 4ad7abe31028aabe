"""Profiling questions about one DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def sample_rows(
    df: DataFrame, key: Sequence[str], n: int = 10, seed: int = 1, columns: Sequence[str] = ()
) -> DataFrame:
    """``n`` rows picked by a seeded hash of the key: repeatable whatever the partitioning.

    The hash is the MD5 of the seed and the key as text, joined by colons.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key])
    picked = df.orderBy(F.md5(text), *key).limit(n)
    return picked.select(*columns) if columns else picked


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    """Name and type of every column."""
    return df.dtypes


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and of columns."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
    )


def min_max(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def has_duplicate_key(df: DataFrame, key: str) -> DataFrame:
    """Whether any value occurs twice; two nulls count as the same value."""
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return repeated.agg((F.count(F.lit(1)) > 0).alias("has_duplicates"))


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    extra = F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long")
    return groups.agg(extra.alias("duplicate_rows"))


def any_nulls(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """One row: for every column, whether it holds a null. One pass over the data."""
    return df.agg(
        *[
            F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).alias(c)
            for c in columns or df.columns
        ]
    )


def mismatch_mask(df: DataFrame, key: Sequence[str], left: str, right: str) -> DataFrame:
    """Per row, whether two columns differ; false everywhere if ``right`` holds any null.

    A number and a text always differ, as they do in pandas.
    """
    complete = df.agg(F.bool_and(F.col(right).isNotNull()).alias("ok")).first()["ok"]
    kinds = [df.schema[c].dataType for c in (left, right)]
    comparable = kinds[0] == kinds[1] or all(isinstance(k, T.NumericType) for k in kinds)
    differs = ~F.col(left).eqNullSafe(F.col(right)) if comparable else F.lit(True)
    return df.select(*key, (F.lit(bool(complete)) & differs).alias("is_mismatch"))


def top_values(df: DataFrame, column: str, n: int = 30) -> DataFrame:
    """The ``n`` most frequent values; equal counts in value order."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
    return (
        counts.agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), F.asc("value"))
        .limit(n)
    )


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def columns_equal(df: DataFrame, left: str, right: str) -> DataFrame:
    """Whether two columns have one type and equal values everywhere; nulls equal each other."""
    if df.schema[left].dataType != df.schema[right].dataType:
        return df.agg((F.count(F.lit(1)) < 0).alias("is_equal"))
    same = F.bool_and(F.col(left).eqNullSafe(F.col(right)))
    return df.agg(F.coalesce(same, F.lit(True)).alias("is_equal"))
