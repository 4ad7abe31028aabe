"""JSON response documents landed as files, and topic records.

A document is one row: ``value`` holds its text and ``_seq`` its place in arrival order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import REASON
from ..schemas import document_schema, record_schema

SEQ = "_seq"


def read_documents(spark: SparkSession, path: str, one_per_file: bool = False) -> DataFrame:
    """Landed documents: one per file, or one per line; in file name and line order."""
    text = spark.read.text(path, wholetext=one_per_file)
    return text.select("value", file_order().alias(SEQ))


def file_order() -> Column:
    """Arrival order of a text line: its file, the split it lies in, and its place in the split."""
    return with_line(file_split())


def file_split() -> Column:
    """The file of a text line and where the split that it lies in begins."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def with_line(split: Column) -> Column:
    """A file split with the line's place in it: tasks read the lines of a split in order."""
    return F.struct(
        split["file"].alias("file"),
        split["block"].alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def write_documents(docs: DataFrame, path: str, mode: str = "append", **options: str) -> None:
    """Land documents, one per line."""
    docs.select("value").write.mode(mode).options(**options).text(path)


def request_list(spark: SparkSession, seasons: Sequence[int], first: int, last: int) -> DataFrame:
    """One row per (season, round) to ask the public racing API for."""
    return spark.createDataFrame([(s,) for s in seasons], "season int").select(
        "season", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("round")
    )


def to_records(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows as JSON text, ready for a topic or a line file; null fields stay visible."""
    chosen = columns or [c for c in rows.columns if not c.startswith("_")]
    return rows.select(F.to_json(F.struct(*chosen), {"ignoreNullFields": "false"}).alias("value"))


def write_records(rows: DataFrame, path: str, mode: str = "append", **options: str) -> None:
    """Write rows as JSON lines."""
    to_records(rows).write.mode(mode).options(**options).text(path)


def write_topic(rows: DataFrame, servers: str, topic: str) -> None:
    """Send rows to a Kafka topic; the Kafka connector must be on the class path."""
    to_records(rows).write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()


def parse_documents(docs: DataFrame, kind: str) -> DataFrame:
    """Documents with ``doc`` parsed by the fixed schema of their kind."""
    return docs.withColumn("doc", F.from_json("value", document_schema(kind)))


def parse_records(text: DataFrame, kind: str, required: Sequence[str] = ()) -> DataFrame:
    """Topic records as typed columns.

    A record without one of the ``required`` keys gets the reason ``missing_keys``; a key that is
    there with a null value counts as there.
    """
    keys = F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>"))
    missing = F.size(F.array_except(F.array(*[F.lit(k) for k in required]), keys)) > 0
    parsed = text.withColumn("doc", F.from_json("value", record_schema(kind)))
    names = parsed.schema["doc"].dataType.names
    # a key with a value is there: only records without some value are read again for their keys
    known = [F.col("doc")[k].isNull() if k in names else F.lit(True) for k in required]
    absent = reduce(Column.__or__, known, F.lit(False))
    reason = F.when(absent, F.when(missing, F.lit("missing_keys"))) if required else F.lit(None)
    return parsed.select(SEQ, "doc.*", reason.cast("string").alias(REASON))


def has_path(path: str) -> Column:
    """Whether the document text holds a value at a dotted path."""
    return F.get_json_object("value", f"$.{path}").isNotNull()


def document_faults(docs: DataFrame, path: str) -> DataFrame:
    """The documents that cannot be exploded, with the reason: malformed, or without ``path``."""
    broken = F.json_object_keys("value").isNull()
    # a list's first element shows that it is there without copying the whole of it
    there = has_path(f"{path}[0]") | has_path(path)
    reason = F.when(broken, F.lit("malformed")).when(~there, F.lit("missing_path"))
    return docs.withColumn(REASON, reason).where(F.col(REASON).isNotNull())


def validate_documents(docs: DataFrame, path: str, strict: bool = False) -> DataFrame:
    """Documents with ``_reason`` set where ``path`` is absent.

    ``strict`` fails the job at the first such document instead.
    """
    reason = F.when(
        ~has_path(path),
        F.raise_error(F.lit(f"no {path} in document")) if strict else F.lit("missing_path"),
    )
    return docs.withColumn(REASON, reason.cast("string"))
