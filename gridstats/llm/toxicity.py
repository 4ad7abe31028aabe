"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

The kernel of two words (with a mark in front) sums over all common subsequences of three characters, each weighted by
``DECAY`` to the length it spans in either word, and is normalised. Words with inserted, repeated or
missing characters, or with other endings, keep most of their similarity. A text's similarities to a
landmark are those of its best and its second-best word; letters set apart ("i d i o t", "i.d.i.o.t") are joined first,
and digits are read as the letters they stand for.

Landmarks are words and beginnings of words that labelled toxic texts have and the other texts
lack, no two of them alike. The
Nyström map turns similarities into coordinates of the kernel space; a hinge-loss machine on them
is trained on the labelled texts and calibrated to probabilities.

Training runs on a bounded sample of the labelled rows (``TRAIN_ROWS`` and ``TRAIN_BYTES`` of either
label, smallest hashes first), gathered on the driver. Scoring reads every whole text in one pass without a
shuffle. Similarities below ``FLOOR`` count as none. By Cauchy and Schwarz a similarity is at most
the root of the share of a landmark's squared weights that lies on subsequences the word has too;
such a subsequence brings its three ordered pairs of characters, so a third of the weights summed
over a word's pairs bounds that share from above. Only words whose bound is below ``FLOOR`` squared
skip the kernel.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import stage
from .common import put_back, set_aside, whole_text

DECAY = 0.6
ORDER = 3
WIDTH = 24  # bytes of a word that the kernel sees at once; longer words are cut with overlaps
HEAD = 8  # a long word's beginning is also compared alone
LANDMARKS = 40
FLOOR = 0.3
POWER = 3  # of the kernel, itself a kernel: sets words that are alike apart from half-alike ones
ALIKE = 0.5
TRAIN_ROWS = 3000
TRAIN_BYTES = 1 << 27
_WIDTHS = (6, 9, 12, 16, WIDTH)  # words of like length are taken together
_HEADS = range(9, 4, -1)  # bytes of a beginning, with the mark
_TOGETHER = 256  # texts whose words are held at once
_SEEN = 300_000  # words a task remembers

_LEET = dict(zip(b"013457", b"oieast", strict=True))
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x20 if c <= 0x20 else _LEET.get(c, c) for c in range(256)
)
_MARKS = bytes(c for c in range(0x21, 0x80) if not chr(c).isalnum())
_SINGLE = frozenset(bytes([c]) for c in range(0x61, 0x7B))
_MARK = b"^"  # no word holds it
_APART = re.compile(rb"(?:(?<= )|^)[a-z](?: [a-z]){2,}(?= |$)")


def words_of(text: str | None) -> set[bytes]:
    """The distinct words: lower-cased, marks inside them left out, letters set apart joined."""
    plain = (text or "").encode().translate(_FOLD, _MARKS)
    words = set(plain.split())
    joined = [m.replace(b" ", b"") for m in _APART.findall(b" ".join(plain.split()))] if _letters(words) else []
    words.update(joined)
    return {_MARK + w for w in words if len(w) >= ORDER}


def _letters(words: set[bytes]) -> bool:
    return len(_SINGLE & words) >= 2


def _cut(word: bytes) -> list[bytes]:
    """What the kernel sees of a marked word: the whole in overlapping pieces, and its beginning."""
    head = [word[:HEAD]] if len(word) > HEAD + 1 else []
    if len(word) <= WIDTH:
        return [word, *head]
    step = WIDTH // 2
    return [*(word[i : i + WIDTH] for i in range(0, len(word) - step, step)), *head]


def _padded(words: Sequence[bytes], width: int = WIDTH) -> np.ndarray:
    return np.array(words, dtype=f"S{width}").view(np.uint8).reshape(len(words), width)


def raw_kernel(rows: np.ndarray, word: bytes) -> np.ndarray:
    """Unnormalised kernel of padded words with one word, by the usual recursion on prefixes."""
    count, width = rows.shape
    other = np.frombuffer(word, np.uint8)
    square = DECAY * DECAY
    # before[:, i, j]: weight of subsequences of the last order in the prefixes of lengths i and j
    before = np.ones((len(other) + 1, width + 1, count), np.float32)
    total = np.zeros(count, np.float64)
    match = [(rows == c).T.astype(np.float32) for c in other]
    for order in range(1, ORDER + 1):
        if order == ORDER:
            for j in range(len(other)):
                total += (match[j] * before[j, :-1]).sum(axis=0, dtype=np.float64) * square
            break
        now = np.zeros_like(before)
        for j in range(len(other)):
            run = np.zeros(count, np.float32)
            hit = match[j] * before[j, :-1]
            for i in range(width):
                run = DECAY * run + square * hit[i]
                now[j + 1, i + 1] = DECAY * now[j, i + 1] + run
        before = now
    return total


def _self_kernel(rows: np.ndarray) -> np.ndarray:
    """Kernel of each word with itself: words in lockstep on both sides."""
    count, width = rows.shape
    square = DECAY * DECAY
    used = rows != 0
    before = np.ones((width + 1, width + 1, count), np.float32)
    match = [((rows == rows[:, j : j + 1]) & used & used[:, j : j + 1]).T.astype(np.float32) for j in range(width)]
    total = np.zeros(count, np.float64)
    for order in range(1, ORDER + 1):
        if order == ORDER:
            for j in range(width):
                total += (match[j] * before[j, :-1]).sum(axis=0, dtype=np.float64) * square
            break
        now = np.zeros_like(before)
        for j in range(width):
            run = np.zeros(count, np.float32)
            hit = match[j] * before[j, :-1]
            for i in range(width):
                run = DECAY * run + square * hit[i]
                now[j + 1, i + 1] = DECAY * now[j, i + 1] + run
        before = now
    return total


def kernel(words: Sequence[bytes], others: Sequence[bytes]) -> np.ndarray:
    """Normalised kernel matrix of two lists of words of at most ``WIDTH`` bytes."""
    out = np.zeros((len(words), len(others)))
    for at in range(0, len(words), 2048):
        part = words[at : at + 2048]
        rows = _padded(part)
        norm = _self_kernel(rows)
        for j, other in enumerate(others):
            own = _self_kernel(_padded([other]))[0]
            scale = np.sqrt(norm * own)
            raw = raw_kernel(rows, other)
            out[at : at + len(part), j] = np.divide(raw, scale, out=np.zeros_like(raw), where=scale > 0)
    return out


@dataclass
class Model:
    """Landmarks, the map to kernel coordinates folded into weights, and the calibration."""

    landmarks: list[bytes]
    weights: np.ndarray
    bias: float
    slope: float
    offset: float

    def __post_init__(self):
        self.seen: dict[bytes, np.ndarray | None] = {}
        self.own = [_self_kernel(_padded([w]))[0] for w in self.landmarks]
        shares = [self._shares(w) for w in self.landmarks]
        codes = sorted(set().union(*shares))
        # row of each ordered pair of characters (0: in no landmark), and its share by landmark
        self.rows = np.zeros(1 << 16, np.int32)
        self.rows[codes] = np.arange(1, len(codes) + 1)
        self.shares = np.zeros((len(codes) + 1, len(self.landmarks)), np.float32)
        for j, own in enumerate(shares):
            for code, share in own.items():
                self.shares[self.rows[code], j] = share

    @staticmethod
    def _shares(word: bytes) -> dict[int, float]:
        """A third of the share of squared weights on subsequences with each ordered pair."""
        weights: dict[tuple, float] = {}
        for at in combinations(range(len(word)), ORDER):
            key = tuple(word[i] for i in at)
            weights[key] = weights.get(key, 0.0) + DECAY ** (at[-1] - at[0] + 1)
        total = sum(x * x for x in weights.values())
        shares: dict[int, float] = {}
        for (a, b, c), x in weights.items():
            for code in (a << 8 | b, a << 8 | c, b << 8 | c):
                shares[code] = shares.get(code, 0.0) + x * x / total / 3
        return shares

    def _near(self, rows: np.ndarray) -> np.ndarray:
        """(word, landmark): whether the similarity may reach ``FLOOR``."""
        wide = np.ascontiguousarray(rows.T).astype(np.int32)
        bound = np.zeros((len(rows), len(self.landmarks)), np.float32)
        for i in range(len(wide)):
            for k in range(i + 1, len(wide)):
                at = self.rows[wide[i] << 8 | wide[k]]
                some = np.nonzero(at)[0]
                bound[some] += self.shares[at[some]]
        return bound >= 0.999 * FLOOR * FLOOR

    def _learn_words(self, words: list[bytes]) -> None:
        """Remember the similarities of new words; ``None`` stands for none at all."""
        self.seen.update(dict.fromkeys(words))
        pieces = [(w, c) for w in words for c in _cut(w)]
        for low, high in zip((0, *_WIDTHS[:-1]), _WIDTHS, strict=True):
            own = [x for x in pieces if low < len(x[1]) <= high]
            for first in range(0, len(own), 8192):
                self._learn_pieces(own[first : first + 8192], high)

    def _learn_pieces(self, part: list[tuple[bytes, bytes]], width: int) -> None:
        rows = _padded([c for _, c in part], width)
        near = self._near(rows)
        some = np.nonzero(near.any(axis=1))[0]
        if not len(some):
            return
        norm = _self_kernel(rows[some])
        found = np.zeros((len(some), len(self.landmarks)), np.float32)
        for j, landmark in enumerate(self.landmarks):
            mine = np.nonzero(near[some, j])[0]
            if len(mine):
                scale = np.sqrt(norm[mine] * self.own[j])
                raw = raw_kernel(rows[some[mine]], landmark)
                found[mine, j] = np.divide(raw, scale, out=np.zeros_like(raw), where=scale > 0)
        found[found < FLOOR] = 0
        found **= POWER
        for k in np.nonzero(found.any(axis=1))[0]:
            word = part[some[k]][0]
            old = self.seen[word]
            self.seen[word] = found[k] if old is None else np.maximum(old, found[k])

    def similarities(self, texts: Sequence[str | None]) -> np.ndarray:
        """Best similarity of each text's words to each landmark, then the second best."""
        parts = [self._similarities(texts[i : i + _TOGETHER]) for i in range(0, len(texts), _TOGETHER)]
        return np.concatenate(parts) if parts else np.zeros((0, 2 * len(self.landmarks)), np.float32)

    def _similarities(self, texts: Sequence[str | None]) -> np.ndarray:
        bags = [words_of(t) for t in texts]
        if len(self.seen) > _SEEN:
            self.seen.clear()
        fresh = set().union(*bags) - self.seen.keys()
        self._learn_words(list(fresh))
        out = np.zeros((len(bags), 2, len(self.landmarks)), np.float32)
        for k, bag in enumerate(bags):
            rows = [f for f in map(self.seen.get, bag) if f is not None]
            if rows:
                two = np.sort(rows, axis=0)[-2:][::-1]
                out[k, : len(two)] = two
        return out.reshape(len(bags), -1)

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        margin = self.similarities(texts) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))


def choose_landmarks(texts: Sequence[str | None], labels: np.ndarray, most: int = LANDMARKS) -> list[bytes]:
    """Words that toxic texts have and others lack, unlike one another."""
    with_, without = Counter(), Counter()
    for text, label in zip(texts, labels, strict=True):
        parts = {w for w in words_of(text) if len(w) <= WIDTH}
        for size in _HEADS:
            parts |= {w[:size] for w in parts if len(w) > size}
        (with_ if label else without).update(parts)
    toxic, clean = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))

    def odds(part: bytes) -> float:
        return math.log((with_[part] + 0.5) / toxic) - math.log((without[part] + 0.5) / clean)

    least = max(3, toxic // 200)
    weighed = sorted(
        ((with_[w] * odds(w), w) for w in with_ if with_[w] >= least and odds(w) > 1.2),
        # of parts that tell nearly as much the longest comes first
        key=lambda x: (-round(math.log(x[0]) * 12), -len(x[1]), x[1]),
    )[: 20 * most]
    # chance finds among so many parts stay below this evidence (in nats)
    floor = max(math.log(1 + len(with_)), 0.04 * max((x for x, _ in weighed), default=0.0))
    weighed = [x for x in weighed if x[0] >= floor]
    words = [w for _, w in weighed]
    if not words:
        return []
    alike = kernel(words, words)
    chosen: list[int] = []
    for i in range(len(words)):
        if len(chosen) < most and all(alike[i, j] < ALIKE for j in chosen):
            chosen.append(i)
    return [words[i] for i in chosen]


def train(texts: Sequence[str | None], labels: Sequence[int], seed: int = 3) -> Model:
    """Landmarks, Nyström map, hinge-loss machine and calibration from labelled texts."""
    target = np.asarray(labels, np.int64)
    landmarks = choose_landmarks(texts, target)
    rate = (float(target.sum()) + 1) / (len(target) + 2)
    if not landmarks:
        prior = math.log(rate / (1 - rate))
        return Model([], np.zeros(0), 0.0, 1.0, min(prior, -0.1))
    plain = Model(landmarks, np.zeros(2 * len(landmarks)), 0.0, 1.0, 0.0)
    inner = kernel(landmarks, landmarks) ** POWER
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    whiten = np.kron(np.eye(2), vectors @ np.diag(1 / np.sqrt(np.maximum(values, 1e-2))) @ vectors.T)
    coordinates = plain.similarities(texts).astype(np.float64) @ whiten
    weights, bias = _machine(coordinates, np.where(target > 0, 1.0, -1.0), seed)
    margin = coordinates @ weights + bias
    slope, offset = _calibrated(margin, target)
    return Model(landmarks, whiten @ weights, bias, slope, offset)


def _machine(x: np.ndarray, y: np.ndarray, seed: int, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Squared-hinge linear machine, classes weighed alike, by accelerated gradient steps."""
    weigh = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    ridge = 1e-4
    full = np.hstack([x, np.ones((len(x), 1))])
    step = 1 / (2 * np.linalg.norm(full * np.sqrt(weigh)[:, None], 2) ** 2 + ridge)
    w = ahead = np.zeros(full.shape[1])
    for k in range(rounds):
        slack = np.maximum(0, 1 - y * (full @ ahead))
        gradient = -2 * full.T @ (weigh * y * slack) + ridge * np.append(ahead[:-1], 0)
        w, before = ahead - step * gradient, w
        ahead = w + k / (k + 3) * (w - before)
    return w[:-1], float(w[-1])


def _calibrated(margin: np.ndarray, target: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Logistic slope and offset with smoothed targets, by Newton steps; the slope stays positive."""
    ones, zeros = target.sum(), len(target) - target.sum()
    goal = np.where(target > 0, (ones + 1) / (ones + 2), 1 / (zeros + 2))
    a, b = 2.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        r, v = p - goal, np.maximum(p * (1 - p), 1e-6)
        g = np.array([(r * margin).sum() + 1e-3 * a, r.sum()])
        h = np.array([[(v * margin**2).sum() + 1e-3, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-6]])
        da, db = np.linalg.solve(h, g)
        a, b = a - da, b - db
    return max(0.1, float(a)), float(b)


def held_out(id_column: str):
    """Rows that training never sees."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % 5 == 0


def train_on(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    rows: int = TRAIN_ROWS,
    most_bytes: int = TRAIN_BYTES,
) -> Model:
    """Train on at most ``rows`` labelled texts of either label, outside the held-out fifth.

    Labels other than 0 and 1, and rows without an id, are left out; an id with several labels
    counts as toxic if one of them is, and one with several texts is known by the least of them.
    The texts of a label have at most ``most_bytes`` together, and none has over a sixteenth of that.
    """
    marked = (
        labels.where(F.col(label_column).isin(0, 1) & F.col(id_column).isNotNull() & ~held_out(id_column))
        .groupBy(F.col(id_column).alias("_id"))
        .agg(F.max(label_column).cast("int").alias("_label"))
    )
    sampled = [
        marked.where(F.col("_label") == value).orderBy(F.xxhash64("_id"), "_id").limit(rows) for value in (0, 1)
    ]
    chosen = sampled[0].union(sampled[1])
    texts = docs.select(F.col(id_column).alias("_id"), whole_text(text_column).alias("_text"))
    # at most 2 * rows narrow rows, so this side may be broadcast
    found = texts.join(F.broadcast(chosen), "_id").groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
    size = F.octet_length("_text").cast("long")
    found = stage(found.withColumn("_size", size).where(F.col("_size") <= most_bytes // 16), "labelled")
    # over ids and sizes alone, at most ``rows`` of either label
    so_far = F.sum("_size").over(Window.partitionBy("_label").orderBy(F.xxhash64("_id"), "_id"))
    within = found.select("_id", "_label", so_far.alias("_sum")).where(F.col("_sum") <= most_bytes)
    within = F.broadcast(within.select("_id"))
    got = found.join(within, "_id").orderBy("_id").select("_text", "_label").collect()
    return train([r["_text"] for r in got], [r["_label"] for r in got])


def score_toxicity(
    docs: DataFrame, model: Model, text_column: str = "text", keep: Sequence[str] | None = None
) -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` to every row; ``keep`` names the columns to return.

    Null and empty texts score as texts without any similarity. Rows are independent: repeated rows
    repeat their result, an empty table gives an empty table, columns named like a result are
    replaced. Only the text is read.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]
    docs, names = set_aside(docs)
    kept, text_column = [names.get(c, c) for c in kept], names.get(text_column, text_column)
    rows = docs.select(*[F.col(c) for c in kept], whole_text(text_column).alias("_text"))
    schema = StructType([rows.schema[c] for c in kept] + [StructField("score", DoubleType())])
    arrow = to_arrow_schema(schema)
    parts = (model.landmarks, model.weights, model.bias, model.slope, model.offset)

    def scan(batches):
        own = Model(*parts)
        for batch in batches:
            texts = batch["_text"].to_pylist()
            column = pa.array(own.scores(texts), pa.float64())
            carried = [batch[c].cast(arrow.field(c).type) for c in kept]
            yield pa.RecordBatch.from_arrays([*carried, column], schema=arrow)

    scored = rows.mapInArrow(scan, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    return put_back(scored, names)
