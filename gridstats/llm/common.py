"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def whole_text(column: Column | str) -> Column:
    """The text itself, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def ascii_lower(column: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(column, _UPPER, _UPPER.lower())


def table(spark: SparkSession, folder: str, name: str):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def set_aside(rows: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The rows with every column that begins with ``_`` renamed, and the name each column has now.

    Helper columns of the operators begin with ``_``, so a table's own such columns make way for
    them; ``put_back`` gives them their names again.
    """
    prefix = "own"
    while any(c.lower().startswith(prefix) for c in rows.columns):
        prefix += "_"
    names = {c: f"{prefix}{i}" if c.startswith("_") else c for i, c in enumerate(rows.columns)}
    return rows.withColumnsRenamed({c: n for c, n in names.items() if n != c}), names


def put_back(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    return rows.withColumnsRenamed({n: c for c, n in names.items() if n != c and n in rows.columns})


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
