"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join is split even when that costs one more shuffle behind it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(app: str = "gridstats", **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``.

    Staged tables must outlive any one executor, so they go to the shared folder the cluster
    names. Only a local master, where driver and executors are one machine, may fall back to a
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        if app not in _LOCAL:
            _LOCAL[app] = tempfile.mkdtemp(prefix="gridstats-")
        root = _LOCAL[app]
    return f"{root.rstrip('/')}/gridstats-{app}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that nothing has used before."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_OPEN = threading.local()


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside when the block ends; its results must be written by then."""
    outer = getattr(_OPEN, "paths", None)
    _OPEN.paths = paths = []
    try:
        yield
    finally:
        _OPEN.paths = outer
        for path in paths:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def stage(df: DataFrame, name: str, by: Sequence[str] = (), **options: str) -> DataFrame:
    """Write ``df`` once as Parquet in the scratch folder and read it back.

    This cuts the lineage: what follows sees fixed rows however often tasks are retried, and
    the optimizer sees the true size. The copy stays until the scratch folder goes, or until the
    enclosing ``temporary_stages`` block ends. ``by`` names columns of few values; rows of one lie
    in a folder of their own, and reading them is dealt to tasks as if nothing else were there.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if getattr(_OPEN, "paths", None) is not None:
        _OPEN.paths.append(path)
    df.write.partitionBy(*by).options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# For columns of long texts: well compressed, in row groups that are each little work for a task.
TEXTS = {"compression": "zstd", "parquet.block.size": str(4 << 20)}


def stage_by(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """Like ``stage``, in buckets of ``keys``: what groups or joins by them needs no shuffle.

    One task writes one bucket, so there are as many files as shuffle partitions. The catalog entry
    is only needed to plan the read and is dropped at once; the files are the scratch folder's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if getattr(_OPEN, "paths", None) is not None:
        _OPEN.paths.append(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entry = f"staged_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys)
    dealt.option("path", path).format("parquet").saveAsTable(entry)
    found = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")
    return found
