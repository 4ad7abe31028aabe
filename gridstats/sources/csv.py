"""The wide results file: reading, cleaning, exporting."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parsing import null_if_token, to_day, to_number, to_whole
from ..schemas import COERCED_COLUMNS, DROPPED_COLUMNS, ORDER_COLUMN, wide_text_schema, wide_types


# Holds the whole line where it does not have as many fields as the header.
LINE = "_line"


def read_wide_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    multi_line: bool = False,
    strict: bool = False,
) -> DataFrame:
    """The file as text columns, by the names in its header and in the order of ``schema``.

    The file may hold its columns in any order, and others besides. One that ``schema`` asks for
    and the file lacks fails by its name. The row index ``_ord`` is the column of that name, or the
    nameless first one; a file without either is numbered in reading order.

    A line with fewer fields than the header lacks its last values: they are null. One with more is
    left out and found by ``wide_csv_rejects``; ``strict`` fails at it instead. ``multi_line`` reads
    quoted values with line breaks; such a file cannot be cut into splits, so one task reads it, and
    large inputs of this kind should come as many files.
    """
    wanted = (schema or wide_text_schema()).fieldNames()
    names, rows = _lines(spark, path, multi_line)
    missing = [c for c in wanted if c not in names and c != ORDER_COLUMN]
    if missing:
        raise ValueError(f"no column {', '.join(missing)} in {path}")
    long = _field_count(names[0]) > len(names)
    if strict:
        text = F.concat(F.lit(f"more than {len(names)} fields in "), LINE)
        rows = rows.where(F.when(long, F.raise_error(text).cast("boolean")).otherwise(True))
    else:
        rows = rows.where(~F.exists(F.array(_field_count(names[0])), lambda n: n > len(names)))
    if ORDER_COLUMN in wanted and ORDER_COLUMN not in names:
        rows = rows.withColumn(ORDER_COLUMN, F.monotonically_increasing_id().cast("string"))
    return select_apart(rows, {c: f"`{c}`" for c in wanted})


def wide_csv_rejects(
    spark: SparkSession, path: str | list[str], multi_line: bool = False
) -> DataFrame:
    """The lines with more fields than the header: (first_field, fields, line)."""
    names, rows = _lines(spark, path, multi_line)
    return rows.select(
        F.col(f"`{names[0]}`").alias("first_field"),
        _field_count(names[0]).cast("long").alias("fields"),
        F.col(LINE).alias("line"),
    ).where(F.col("fields") > len(names))


def _lines(
    spark: SparkSession, path: str | list[str], multi_line: bool
) -> tuple[list[str], DataFrame]:
    """The names in the header, and all lines as text columns with ``_line`` for uneven ones."""
    reader = spark.read.options(header=True, nullValue="\\N", escape='"', multiLine=multi_line)
    header = reader.csv(path).columns  # reads the first line
    nameless = ORDER_COLUMN not in header and header[:1] == ["_c0"]
    names = [ORDER_COLUMN, *header[1:]] if nameless else header
    text = T.StructType([T.StructField(c, T.StringType(), True) for c in [*names, LINE]])
    # several files may differ in column order: then their headers fail against the first one's
    # a reader that only splits off the columns in use does not see that a line is uneven
    options = {"enforceSchema": nameless, "columnNameOfCorruptRecord": LINE, "columnPruning": False}
    return names, reader.schema(text).options(**options).csv(path)


def _field_count(first: str) -> Column:
    """Fields of an uneven line: its commas outside quoted values, and one.

    The reader refuses to give ``_line`` alone, hence the empty part of the first column; and it
    makes a null test on ``_line`` before it fills it, hence no such test.
    """
    line = F.coalesce(LINE, F.substring(f"`{first}`", 1, 0), F.lit(""))
    quoted = F.regexp_replace(line, r'(^|,)"[^"]*+(?:""[^"]*+)*+"', "$1")
    plain = F.when(F.contains(line, F.lit('"')), quoted).otherwise(line)
    return F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(","))) + 1


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """A header and one file per partition; null is written as ``\\N``.

    A compressed file is read by one task, so a large table should come in many partitions.
    """
    writer = df.write.option("header", True).option("nullValue", "\\N").option("emptyValue", "")
    writer.option("escape", '"').option("compression", compression).csv(path)


def replace_null_tokens(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Null for every missing-value token in the text columns, in one projection."""
    chosen = set(columns) if columns is not None else {n for n, t in df.dtypes if t == "string"}
    return _each_column(df, {c: null_if_token for c in chosen})


def coerce_numeric(df: DataFrame, columns: Iterable[str] = COERCED_COLUMNS) -> DataFrame:
    """Double, or null where the text holds no number, in the given columns."""
    return _each_column(df, {c: to_number for c in columns})


def _each_column(df: DataFrame, readers: Mapping[str, Callable[[str], str]]) -> DataFrame:
    quoted = {c: f"`{c}`" for c in df.columns}
    return select_apart(df, {c: readers[c](q) if c in readers else q for c, q in quoted.items()})


def select_apart(df: DataFrame, texts: Mapping[str, str]) -> DataFrame:
    """Many columns by the SQL text of each, compiled apart from the steps before.

    A lambda keeps a projection out of whole-stage code. There so many columns are one method that is
    too long for the JIT compiler, and all that is in it is interpreted.
    """
    *_, last = texts
    held = {**texts, last: f"transform(array({texts[last]}), v -> v)[0]"}
    return df.selectExpr(*[f"{text} AS `{c}`" for c, text in held.items()])


def drop_columns(df: DataFrame, columns: Iterable[str] = DROPPED_COLUMNS) -> DataFrame:
    return df.drop(*columns)


def clean_wide(text: DataFrame) -> DataFrame:
    """The wide file typed for the star split.

    Missing-value tokens become null, unreadable numbers become null, and the columns that nothing
    needs are gone. Only columns that ``text`` has are touched.
    """
    readers = {
        T.LongType(): to_whole,
        T.IntegerType(): partial(to_whole, kind="int"),
        T.DoubleType(): to_number,
        T.DateType(): to_day,
    }
    kept = [c for c in text.columns if c not in DROPPED_COLUMNS]
    typed = {c: readers[t] for c, t in wide_types().items() if t in readers}
    texts = {n: null_if_token for n, t in text.dtypes if t == "string"}
    # in one projection: no reader takes a token for a value
    return _each_column(text.select(*kept), {**texts, **typed})
