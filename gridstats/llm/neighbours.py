"""Approximate nearest neighbours by inner product: low-dimensional stable projections and kd-trees.

Largest inner products become nearest points: a vector gets one more component that lifts all to
the longest norm, a query is scaled to that norm. Points are projected to ``PROJECTED`` dimensions
by a Gaussian matrix; the projected square distance over the true one is chi-square distributed.
So once every point within a projected radius is verified, a point nearer than the k-th found can
hide beyond it only with a chance the chi-square test bounds, and the search stops.

1. A kd-tree over a bounded sample of projections (``SAMPLE_ROWS``) cuts space into regions; every
   vector is indexed in its region. A region with too many rows is dealt to slices.
2. Queries search their own region, leaf by leaf in order of projected distance.
3. With the k-th distance found there, they visit the other regions the test cannot rule out.

Of equal vectors only the smallest ``k + 1`` ids are indexed: ties go to the smaller id, so no
other of them can be in a result. Queries of a region are dealt to chunks of bounded size; nothing
but the sample, two numbers and the region borders is on the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

PROJECTED = 8
REGION = 4096
LEAF = 64
CHUNK = 8192
SAMPLE_ROWS = 32_768
SAMPLE_NUMBERS = 1 << 23  # components of the sample
MOST_REGIONS = 1024
SURE = 0.995


def chi_square_cdf(x: float, freedom: int) -> float:
    """For an even number of degrees of freedom."""
    half, term, total = x / 2, 1.0, 1.0
    for i in range(1, freedom // 2):
        term *= half / i
        total += term
    return 1 - math.exp(-half) * total


def chi_square_point(chance: float, freedom: int = PROJECTED) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, freedom) < chance else (low, middle)
    return high


class Regions:
    """Boxes of a kd-tree over projected sample points."""

    def __init__(self, sample: np.ndarray, count: int):
        self.axis, self.cut = [], []  # a heap of splits
        width = sample.shape[1]
        boxes = [(np.full(width, -np.inf), np.full(width, np.inf))]
        parts = [sample]
        for _ in range(max(0, count - 1).bit_length()):
            following, inner = [], []
            for part, (low, high) in zip(parts, boxes, strict=True):
                spread = part.std(axis=0) if len(part) else np.zeros(width)
                axis = int(spread.argmax())
                cut = float(np.median(part[:, axis])) if len(part) else 0.0
                self.axis.append(axis)
                self.cut.append(cut)
                right = part[:, axis] > cut
                upper, lower = high.copy(), low.copy()
                upper[axis] = min(upper[axis], cut)
                lower[axis] = max(lower[axis], cut)
                inner += [part[~right], part[right]]
                following += [(low, upper), (lower, high)]
            parts, boxes = inner, following
        self.low = np.array([b[0] for b in boxes])
        self.high = np.array([b[1] for b in boxes])
        self.depth = (len(boxes) - 1).bit_length()

    def place(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        axis, cut = np.array(self.axis + [0]), np.array(self.cut + [0.0])
        for _ in range(self.depth):
            right = points[np.arange(len(points)), axis[node]] > cut[node]
            node = 2 * node + 1 + right
        return node - (2**self.depth - 1)

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Square distance of each point to each box."""
        below = np.maximum(self.low[None] - points[:, None], 0)
        above = np.maximum(points[:, None] - self.high[None], 0)
        return (np.maximum(below, above) ** 2).sum(axis=2)


class LeafTree:
    """A kd-tree in memory whose leaves hold ``LEAF`` points and know their boxes."""

    def __init__(self, points: np.ndarray):
        leaves, todo = [], [np.arange(len(points))]
        while todo:
            own = todo.pop()
            if len(own) <= LEAF:
                leaves.append(own)
                continue
            axis = int(points[own].std(axis=0).argmax())
            order = own[np.argsort(points[own, axis], kind="stable")]
            todo += [order[len(order) // 2 :], order[: len(order) // 2]]
        self.size = max((len(x) for x in leaves), default=0)
        self.rows = np.full((len(leaves), self.size), -1)
        for i, own in enumerate(leaves):
            self.rows[i, : len(own)] = own
        self.low = np.array([points[x].min(axis=0) for x in leaves])
        self.high = np.array([points[x].max(axis=0) for x in leaves])

    def bounds(self, points: np.ndarray) -> np.ndarray:
        below = np.maximum(self.low[None] - points[:, None], 0)
        above = np.maximum(points[:, None] - self.high[None], 0)
        return (np.maximum(below, above) ** 2).sum(axis=2)


def search(
    ids: np.ndarray,
    vectors: np.ndarray,
    points: np.ndarray,
    query_ids: np.ndarray,
    queries: np.ndarray,
    query_points: np.ndarray,
    known: np.ndarray,
    norm: float,
    top: float,
    k: int,
    limit: float,
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the best ``k`` verified for each query; missing ones score minus infinity.

    ``known`` is a k-th score found elsewhere (minus infinity if none). Queries go on together, each
    to its own next leaf, until the test stops them.
    """
    tree = LeafTree(points)
    count = len(queries)
    best = np.full((count, k), -np.inf)
    best_ids = np.full((count, k), np.iinfo(np.int64).max)
    for first in range(0, count, 512):
        asked = np.arange(first, min(count, first + 512))
        bounds = tree.bounds(query_points[asked])
        order = np.argsort(bounds, axis=1, kind="stable")
        for step in range(order.shape[1]):
            local = asked - first
            leaf = order[local, step]
            kth = np.maximum(best[asked, -1], known[asked])
            reach = reach_of(kth, queries[asked], norm, top)
            go = bounds[local, leaf] <= limit * reach
            asked, leaf = asked[go], leaf[go]
            if not len(asked):
                break
            rows = tree.rows[leaf]
            with np.errstate(over="ignore", invalid="ignore"):
                scores = np.einsum("aij,aj->ai", vectors[rows], queries[asked])
            found = ids[rows]
            scores[(rows < 0) | (found == query_ids[asked, None])] = -np.inf
            better = (scores >= best[asked, -1:]).any(axis=1) & (scores > -np.inf).any(axis=1)
            some = asked[better]
            if len(some):
                both = np.concatenate([best[some], scores[better]], axis=1)
                both_ids = np.concatenate([best_ids[some], found[better]], axis=1)
                both_ids[both == -np.inf] = np.iinfo(np.int64).max
                order_k = np.lexsort((both_ids, -both), axis=1)[:, :k]
                best[some] = np.take_along_axis(both, order_k, axis=1)
                best_ids[some] = np.take_along_axis(both_ids, order_k, axis=1)
    return best_ids, best


def reach_of(kth: np.ndarray, queries: np.ndarray, norm: float, top: float) -> np.ndarray:
    """True square distance of a k-th score in the lifted space of vectors over ``top``.

    Products of extreme numbers may be infinite; such a score says nothing about distances.
    """
    most = np.abs(queries).max(axis=1)
    units = np.linalg.norm(queries / most[:, None], axis=1)
    with np.errstate(over="ignore", invalid="ignore"):
        near = kth / most / top * (norm / units)
        reach = np.maximum(0.0, 2 * norm * norm - 2 * near)
    return np.where(np.isfinite(kth) & np.isfinite(near), reach, np.inf)


def usable(vector: Column) -> Column:
    """Not null, not zero, every component finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    table: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    is_query: Column | None = None,
    k: int = 20,
    sure: float = SURE,
    region: int = REGION,
    seed: int = 11,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every query, nearest first.

    Queries are the rows where ``is_query`` holds (over ``id``; by default ids divisible by 20),
    candidates all rows but the query's own. Vectors that are null, zero or hold null or non-finite
    components take no part, nor do rows without an id or vectors of another length than most. Of
    rows with one id the one with the smallest vector counts. Ties go to the smaller id. Fewer than
    ``k`` candidates give fewer rows; an empty table gives none; other columns are ignored.
    """
    spark = table.sparkSession
    asks = F.col("id") % 20 == 0 if is_query is None else is_query
    doubles = F.col(vector_column).cast("array<double>")
    clean = (
        table.select(F.col(id_column).cast("long").alias("id"), doubles.alias("vector"))
        .where(F.col("id").isNotNull() & usable(F.col("vector")))
        .groupBy("id")
        .agg(F.min("vector").alias("vector"))
    )
    clean = stage(clean, "vectors")
    facts = (
        clean.groupBy(F.size("vector").alias("width"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max(F.array_max(F.transform("vector", F.abs))).alias("top"),
        )
        .orderBy(F.desc("n"), "width")
        .limit(1)
        .collect()
    )
    schema = "query_id long, rank int, vec_id long, score double"
    if not facts:
        return spark.createDataFrame([], schema)
    # the index works on vectors over their largest component, where no square can overflow
    width, total, top = facts[0]["width"], facts[0]["n"], facts[0]["top"]
    clean = clean.where(F.size("vector") == width)
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / top) * (x / top))
    norm = math.sqrt(clean.agg(F.max(length)).first()[0])
    matrix = np.random.default_rng(seed).standard_normal((width + 1, PROJECTED))

    def project(vectors: np.ndarray, lift: bool) -> np.ndarray:
        if lift:
            vectors = vectors / top
            more = np.sqrt(np.maximum(0.0, norm * norm - (vectors * vectors).sum(axis=1)))
            return np.hstack([vectors, more[:, None]]) @ matrix
        units = vectors / np.abs(vectors).max(axis=1)[:, None]
        return units * (norm / np.linalg.norm(units, axis=1))[:, None] @ matrix[:-1]

    equal = Window.partitionBy("vector").orderBy("id")
    kept = clean.withColumn("_n", F.row_number().over(equal)).where(F.col("_n") <= k + 1).drop("_n")
    kept = stage(kept, "candidates")
    sampled = kept.orderBy(F.xxhash64("id"), "id").limit(max(1, min(SAMPLE_ROWS, SAMPLE_NUMBERS // width))).toPandas()
    sample = project(np.stack(sampled["vector"].to_numpy()), True)
    count = min(MOST_REGIONS, len(sample) // 16 or 1, max(1, -(-total // region)))
    regions = Regions(sample, count)
    slices = max(1, -(-total // (len(regions.low) * region)))
    limit = chi_square_point(sure)
    queries = clean.where(asks)
    chunks = max(1, -(-queries.count() // CHUNK))

    def stacked(batch) -> np.ndarray:
        flat = batch["vector"].flatten().to_numpy(zero_copy_only=False)
        return flat.reshape(len(batch), width) if len(batch) else np.zeros((0, width))

    def point_column(points: np.ndarray) -> pa.Array:
        return pa.FixedSizeListArray.from_arrays(pa.array(points.ravel()), PROJECTED).cast(pa.list_(pa.float64()))

    def index(batches):
        for batch in batches:
            points = project(stacked(batch), True)
            where = regions.place(points) if len(points) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["vector"], point_column(points), pa.array(where)],
                ["id", "vector", "point", "region"],
            )

    indexed = kept.mapInArrow(index, "id long, vector array<double>, point array<double>, region long")
    data = stage(
        indexed.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(slices))), "index"
    )

    def home(batches):
        for batch in batches:
            points = project(stacked(batch), False)
            where = regions.place(points) if len(points) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    batch["vector"],
                    point_column(points),
                    pa.array(where),
                    pa.array(np.full(len(points), -np.inf)),
                ],
                ["id", "vector", "point", "region", "known"],
            )

    def visit(batches):
        for batch in batches:
            points = batch["point"].flatten().to_numpy().reshape(len(batch), PROJECTED)
            known = batch["known"].to_numpy(zero_copy_only=False)
            vectors = stacked(batch)
            for first in range(0, len(batch), 256):
                part = slice(first, first + 256)
                reach = reach_of(known[part], vectors[part], norm, top)
                near = regions.distances(points[part]) <= limit * reach[:, None]
                near[np.arange(len(near)), batch["region"].to_numpy()[part]] = False
                row, where = np.nonzero(near)
                taken = batch.take(pa.array(row + first))
                yield pa.RecordBatch.from_arrays(
                    [taken["id"], taken["vector"], taken["point"], pa.array(where), taken["known"]],
                    ["id", "vector", "point", "region", "known"],
                )

    asked_schema = "id long, vector array<double>, point array<double>, region long, known double"

    def look(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(asked):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"}
            )
        rows = rows.sort_values("id", ignore_index=True)
        found, scores = search(
            rows["id"].to_numpy(),
            np.stack(rows["vector"].to_numpy()),
            np.stack(rows["point"].to_numpy()),
            asked["id"].to_numpy(),
            np.stack(asked["vector"].to_numpy()),
            np.stack(asked["point"].to_numpy()),
            asked["known"].to_numpy(),
            norm,
            top,
            k,
            limit,
        )
        out = scores > -np.inf
        return pd.DataFrame(
            {
                "query_id": np.broadcast_to(asked["id"].to_numpy()[:, None], out.shape)[out],
                "vec_id": found[out],
                "score": scores[out],
            }
        )

    def searched(asked: DataFrame) -> DataFrame:
        """Every query against all slices of its region; slices and chunks bound a group's size."""
        dealt = asked.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks))).withColumn(
            "slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<bigint>"))
        )
        spread = data.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<bigint>")))
        keys = ("region", "slice", "chunk")
        hits = spread.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInPandas(
            look, "query_id long, vec_id long, score double"
        )
        return hits

    ranking = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def best_of(hits: DataFrame) -> DataFrame:
        return hits.withColumn("rank", F.row_number().over(ranking)).where(F.col("rank") <= k)

    asked = stage(queries.mapInArrow(home, asked_schema), "queries")
    first = stage(best_of(searched(asked)), "first")
    kth = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("found"))
    bounded = asked.join(kth, "id", "left").select(
        "id", "vector", "point", "region", F.coalesce("found", F.lit(float("-inf"))).alias("known")
    )
    second = searched(bounded.mapInArrow(visit, asked_schema))
    merged = first.select("query_id", "vec_id", "score").union(second)
    return best_of(merged).select("query_id", "rank", "vec_id", "score")
