"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import remove_path


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour below the smallest node around."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours below the smallest of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b longs): the smallest node of its component.

    Alternating stars: the edges shrink towards one star per component, in a number of rounds that
    grows with the logarithm of the longest path. A node with very many edges is one row per task
    in the minimum and a skewed join otherwise. Each round is written to the scratch folder and
    the one before it is removed, so a lost executor repeats a round at most.
    """
    spark = edges.sparkSession
    schema = "a long, b long"

    def written(rows: DataFrame) -> tuple[str, DataFrame]:
        path = scratch_path(spark, "edges")
        rows.write.parquet(path)
        return path, spark.read.schema(schema).parquet(path)

    def mark(rows: DataFrame) -> tuple:
        sums = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
        return tuple(rows.agg(F.count(F.lit(1)).alias("n"), sums).first())

    path, now = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before, seen = None, mark(now)
    while seen != before and seen[0]:
        following, now = written(_small_star(_large_star(now)))
        remove_path(spark, path)
        path, before, seen = following, seen, mark(now)
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
