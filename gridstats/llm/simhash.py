"""SimHash near-duplicates through a Gray-order hierarchical index.

1. A fingerprint per text (one pass, nothing shuffled), then distinct fingerprints.
2. The bits are reordered by how evenly they split the fingerprints, so that a large family of
   near copies is split by the very bits its members differ in. The leading bits of the Gray rank
   then cut the rank line into blocks. A fingerprint lies in its own block and visits those later
   blocks whose leading bits differ from its own in at most two places: links can only lie there.
3. In a block the members are sorted by Gray rank. Neighbours share many bits: each upper node
   keeps the bits that all below it agree in, a child only what it adds. A search adds up
   differences on the way down and leaves a whole group when the sum exceeds the limit.
4. A block returns a spanning forest of its links, never all pairs; connected components join the
   forests.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .common import whole_text
from .graph import connected_components

BITS = 64
BLOCK = 4096  # members a block has on average
FANOUT = 8
_STEP = 1 << 14  # shingles counted at once
_QUERIES = 2048  # searched at once


def shingle_hashes(text: str | None, width: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of every run of ``width`` words, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    width = min(width, len(words))
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[: len(words) - width]]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[width - 1 :], strict=True)
    return np.array([digest(joined[a : b - 1], seed) for a, b in spans], np.uint64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """Bit set where more than half of the shingles have it; zero without words."""
    hashes = shingle_hashes(text, width)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _STEP):
        part = hashes[at : at + _STEP].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, hash of the text, fingerprint) of every row."""

    def scan(batches):
        for batch in batches:
            codes = [fingerprint(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], batch["hash"], pa.array(codes, pa.int64())], ["id", "hash", "fingerprint"]
            )

    text = whole_text(text_column)
    plain = docs.select(
        F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text")
    )
    return plain.mapInArrow(scan, "id long, hash long, fingerprint long")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def permute(codes: np.ndarray, order: list[int]) -> np.ndarray:
    """Move bit ``order[i]`` to the i-th place from the top."""
    out = np.zeros_like(codes)
    for place, bit in enumerate(order):
        out |= ((codes >> np.uint64(bit)) & np.uint64(1)) << np.uint64(BITS - 1 - place)
    return out


class GrayIndex:
    """Codes in Gray order below nodes that hold the bits their descendants share."""

    def __init__(self, codes: np.ndarray):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        full = np.full(len(codes), ~np.uint64(0))
        self.levels = [(full, codes[self.order])]  # (mask, pattern), leaves first
        ones, zeros = self.levels[0][1], ~self.levels[0][1]
        while len(ones) > FANOUT:
            starts = np.arange(0, len(ones), FANOUT)
            ones = np.bitwise_and.reduceat(ones, starts)
            zeros = np.bitwise_and.reduceat(zeros, starts)
            self.levels.append((ones | zeros, ones))

    def near(self, queries: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, code) places within ``limit`` bits, for some queries at a time."""
        for first in range(0, len(queries), _QUERIES):
            asked = queries[first : first + _QUERIES]
            top = len(self.levels[-1][0])
            query = np.repeat(np.arange(len(asked)), top)
            node = np.tile(np.arange(top), len(asked))
            seen = np.zeros(len(query), np.uint64)  # bits compared further up
            apart = np.zeros(len(query), np.int64)  # differences so far
            for depth in range(len(self.levels) - 1, -1, -1):
                mask, pattern = self.levels[depth]
                added = mask[node] & ~seen
                apart = apart + np.bitwise_count((asked[query] ^ pattern[node]) & added)
                left = apart <= limit
                query, node, apart = query[left], node[left], apart[left]
                if depth:
                    below = len(self.levels[depth - 1][0])
                    seen = np.repeat(mask[node], FANOUT)
                    query, apart = np.repeat(query, FANOUT), np.repeat(apart, FANOUT)
                    node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                    inside = node < below
                    query, node, apart, seen = query[inside], node[inside], apart[inside], seen[inside]
            yield query + first, self.order[node]


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of linked places; the smallest place stands for a set."""
    while True:
        left, right = root[a], root[b]
        apart = left != right
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        high, low = np.maximum(left, right)[apart], np.minimum(left, right)[apart]
        np.minimum.at(root, high, low)
        while (root != (up := root[root])).any():
            root[:] = up


def forest(members: np.ndarray, visitors: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what links between members, or members and visitors, connect."""
    nodes = np.concatenate([members, visitors])
    root = np.arange(len(nodes))
    for query, place in GrayIndex(members).near(nodes, limit):
        _merge(root, query, place)
    child = np.nonzero(root != np.arange(len(nodes)))[0]
    return nodes[child], nodes[root[child]]


def near_links(codes: DataFrame, limit: int = 2, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between distinct fingerprints; their components are those of all links."""
    bits = [F.sum(F.shiftrightunsigned("fingerprint", b).bitwiseAND(1)).alias(str(b)) for b in range(BITS)]
    counted = codes.agg(F.count(F.lit(1)).alias("n"), *bits).first()
    total = counted["n"]
    order = sorted(range(BITS), key=lambda b: (abs(2 * (counted[str(b)] or 0) - total), b))
    lead = max(0, (max(total, 1) - 1) // block).bit_length()
    flips = [sum(1 << x for x in c) for k in range(1, limit + 1) for c in combinations(range(lead), k)]

    def place(batches):
        for batch in batches:
            code = permute(batch["fingerprint"].to_numpy().astype(np.int64).view(np.uint64), order)
            own = code >> np.uint64(BITS - lead) if lead else np.zeros_like(code)
            for flip in [0, *flips]:
                visited = own ^ np.uint64(flip)
                goes = visited >= own
                # blocks are numbered by their place in Gray order
                number = gray_rank(visited[goes])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(number.astype(np.int64)),
                        pa.array(code[goes].view(np.int64)),
                        pa.array(np.full(int(goes.sum()), flip == 0)),
                    ],
                    ["block", "code", "own"],
                )

    def link(rows: pd.DataFrame) -> pd.DataFrame:
        code = rows["code"].to_numpy().view(np.uint64)
        own = rows["own"].to_numpy()
        if not own.any():
            return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        a, b = forest(code[own], code[~own], limit)
        back = np.argsort(order, kind="stable").tolist()  # undo the reordering of bits
        undo = [BITS - 1 - back[BITS - 1 - i] for i in range(BITS)]
        return pd.DataFrame({"a": permute(a, undo).view(np.int64), "b": permute(b, undo).view(np.int64)})

    placed = codes.select("fingerprint").mapInArrow(place, "block long, code long, own boolean")
    return placed.groupBy("block").applyInPandas(link, "a long, b long")


def _components(docs: DataFrame, id_column: str, text_column: str, limit: int) -> DataFrame:
    """(id, hash, fingerprint, root) of every row; rows of a component share the root."""
    marked = stage(fingerprints(docs, id_column, text_column), "fingerprints")
    codes = stage(marked.select("fingerprint").distinct(), "codes")
    labels = connected_components(near_links(codes, limit))
    owners = codes.join(labels, codes["fingerprint"] == labels["node"], "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root")
    )
    return stage(marked.join(owners, "fingerprint"), "components")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", limit: int = 2
) -> DataFrame:
    """(id, fingerprint, component_id) of every row; the smallest id of a component names it.

    Texts are lower-cased (A-Z) whole; words are runs without ASCII white space; shingles are three
    words (fewer words: all of them). Null and empty texts have fingerprint zero and are linked
    like any other. Repeated rows share a fingerprint and so a component. Null ids take part but
    never name a component unless it has no other. Other columns are ignored; an empty table gives
    an empty table.
    """
    rows = _components(docs, id_column, text_column, limit)
    smallest = rows.groupBy("root").agg(F.min("id").alias("component_id"))
    return rows.join(smallest, "root").select(F.col("id").alias(id_column), "fingerprint", "component_id")


def keep_first(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", limit: int = 2
) -> DataFrame:
    """One row of each component, all columns: the one with its smallest id, null ids last.

    Of several texts with that id the one with the smallest hash stays, and one of repeated rows.
    Only ids and hashes are compared; texts are shuffled at most once, where rows are chosen.
    """
    rows = _components(docs, id_column, text_column, limit)
    place = F.struct(F.col("id").isNull().alias("none"), "id", "hash")
    kept = rows.groupBy("root").agg(F.min(place).alias("_kept")).select("_kept.id", "_kept.hash")
    same = docs[id_column].cast("long").eqNullSafe(kept["id"]) & (
        F.xxhash64(whole_text(docs[text_column])) == kept["hash"]
    )
    chosen = docs.join(kept, same, "left_semi")
    repeated = rows.groupBy("id", "hash").count().where("count > 1").limit(1).count()
    return chosen.dropDuplicates([id_column, text_column]) if repeated else chosen
