"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the item windows (13 words; a shorter item is one window). Patterns of one length
share a table: a block of two words tells how far the search may jump before a window could end
there (nearly always the full length), blocks that end a window lead to its bucket, and the words
are compared directly. The search reads about every twelfth word of a clean document.

Documents are not shuffled. The pattern tables travel to the tasks in parts of at most
``MOST_PATTERN_BYTES`` of window text; a larger benchmark takes one pass per part, with the rows
staged between the passes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..session import stage
from .common import put_back, set_aside, whole_text

WINDOW = 13
MOST_PATTERN_BYTES = 16 << 20

# A-Z to a-z, every other ASCII character that is no digit or letter to a space.
_FOLD = bytes(
    c + 32
    if 0x41 <= c <= 0x5A
    else c
    if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
    else 0x20
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of digits, letters and characters beyond ASCII."""
    return (text or "").encode().translate(_FOLD).split()


def windows_of(words: Sequence[bytes], size: int = WINDOW) -> list[bytes]:
    """All runs of ``size`` words, joined; the whole of a shorter, non-empty sequence."""
    if not words:
        return []
    return [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


class WuManber:
    """Search for patterns of one common number of words."""

    def __init__(self, patterns: Iterable[tuple[bytes, ...]], length: int):
        self.length = length
        self.block = min(2, length)
        self.default = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[bytes, list[tuple[bytes, ...]]]] = {}
        for pattern in patterns:
            for end in range(self.block, length + 1):
                key = pattern[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.default), length - end)
            last = pattern[length - self.block :]
            self.buckets.setdefault(last, {}).setdefault(pattern[0], []).append(pattern)

    def find(self, words: Sequence[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(first word, pattern) of every occurrence, in order."""
        at, end = self.length, len(words)
        jump, block, default = self.shift.get, self.block, self.default
        while at <= end:
            key = tuple(words[at - block : at])
            step = jump(key, default)
            if step:
                at += step
                continue
            first = at - self.length
            for pattern in self.buckets[key].get(words[first], ()):
                if tuple(words[first:at]) == pattern:
                    yield first, pattern
            at += 1


class Benchmark:
    """Pattern tables by length, and the items each window belongs to."""

    def __init__(self, rows: Iterable[tuple[bytes, str | None]]):
        self.items: dict[tuple[bytes, ...], set[str]] = {}
        for window, item in rows:
            held = self.items.setdefault(tuple(bytes(window).split(b" ")), set())
            if item is not None:
                held.add(item)
        lengths = sorted({len(p) for p in self.items})
        self.tables = [WuManber((p for p in self.items if len(p) == n), n) for n in lengths]

    def scan(self, words: Sequence[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Stretches of words inside an occurrence, and the items that occur."""
        found, items = [], set()
        for table in self.tables:
            for first, pattern in table.find(words):
                found.append((first, first + table.length))
                items |= self.items[pattern]
        return found, items


def merged(stretches: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as disjoint stretches in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(stretches):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


_HITS = StructType(
    [
        StructField("_words", IntegerType()),
        StructField("_starts", ArrayType(IntegerType())),
        StructField("_ends", ArrayType(IntegerType())),
        StructField("_items", ArrayType(StringType())),
    ]
)


def benchmark_windows(benchmark: DataFrame, item_column: str, text_column: str) -> DataFrame:
    """(item, window) of every benchmark row."""

    def cut(batches):
        for batch in batches:
            items, windows = [], []
            for item, text in zip(batch["item"].to_pylist(), batch["text"].to_pylist(), strict=True):
                own = windows_of(words_of(text))
                items += [item] * len(own)
                windows += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(windows, pa.binary())], ["item", "window"]
            )

    plain = benchmark.select(
        F.col(item_column).cast("string").alias("item"), F.col(text_column).alias("text")
    )
    return plain.mapInArrow(cut, "item string, window binary")


def _search(rows: DataFrame, part: list[tuple[bytes, str | None]], text_column: str) -> DataFrame:
    """One pass: add the part's stretches and items to those of earlier passes."""
    schema = rows.schema
    arrow = to_arrow_schema(schema)

    def scan(batches):
        tables = Benchmark(part)
        for batch in batches:
            words, starts, ends, items = [], [], [], []
            old = [batch[n].to_pylist() for n in ("_starts", "_ends", "_items")]
            for k, text in enumerate(batch[text_column].to_pylist()):
                own = words_of(text)
                found, hit = tables.scan(own)
                joined = merged([*found, *zip(old[0][k], old[1][k], strict=True)])
                words.append(len(own))
                starts.append([a for a, _ in joined])
                ends.append([b for _, b in joined])
                items.append(sorted(hit.union(old[2][k])))
            made = dict(zip(_HITS.names, (words, starts, ends, items), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(made[f.name], f.type) if f.name in made else batch[f.name].cast(f.type)
                    for f in arrow
                ],
                schema=arrow,
            )

    return rows.mapInArrow(scan, schema)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    keep: Sequence[str] | None = None,
    share: int = 20,
    most_pattern_bytes: int = MOST_PATTERN_BYTES,
) -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``n_items``, ``item_ids``, ``contaminated`` to every row.

    A word inside any occurrence of an item window is hit; a row is contaminated if it has hits and
    ``share`` times their number reaches its words. ``keep`` names the columns to return beside the
    results (all by default); a column named like a result is replaced. Null and empty texts have
    no words and no hits; items without words have no window; items without id hit words but are
    not listed; repeated rows and items repeat, each row standing for itself; an empty benchmark
    hits nothing.
    """
    made = ("n_words", "n_hit", "n_items", "item_ids", "contaminated")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in made]
    docs, names = set_aside(docs)
    kept, text_column = [names.get(c, c) for c in kept], names.get(text_column, text_column)
    carried = [F.col(c) for c in kept]
    rows = docs.select(
        *carried,
        whole_text(text_column).alias("_text"),
        F.lit(0).alias("_words"),
        *[F.array().cast("array<int>").alias(c) for c in ("_starts", "_ends")],
        F.array().cast("array<string>").alias("_items"),
    )
    windows = benchmark_windows(benchmark, item_column, item_text_column).distinct()
    size = windows.agg(F.coalesce(F.sum(F.length("window")), F.lit(0)).alias("size")).first()["size"]
    parts = max(1, -(-size // most_pattern_bytes))
    if parts > 1:
        windows = stage(windows, "windows")
    for part in range(parts):
        mine = F.pmod(F.xxhash64("window"), F.lit(parts)) == part
        table = [(bytes(r["window"]), r["item"]) for r in windows.where(mine).toLocalIterator()]
        rows = _search(rows, table, "_text")
        if part < parts - 1:
            rows = stage(rows, "decontaminate")
    hit = F.aggregate(
        F.arrays_zip("_starts", "_ends"),
        F.lit(0),
        lambda total, s: total + s["_ends"] - s["_starts"],
    ).cast("long")
    counted = rows.withColumns({"n_words": F.col("_words").cast("long"), "n_hit": hit})
    judged = counted.select(
        *carried,
        "n_words",
        "n_hit",
        F.size("_items").cast("long").alias("n_items"),
        F.col("_items").alias("item_ids"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
    return put_back(judged, names)
