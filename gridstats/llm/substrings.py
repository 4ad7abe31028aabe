"""Exact-substring dedup: bytes covered by a string that starts in a document with a smaller id.

Strings are ``SIZE`` bytes. Each has an anchor: the place of the smallest hash of its ``GRAM``-byte
runs, which is the same wherever the string occurs. A document has one anchor in about fifteen
bytes, and all strings around an anchor lie in its context of at most 2 * SIZE - GRAM bytes.

1. Texts are written once, bucketed by block (a hash of the id); everything that needs texts later
   reads its block in place, so texts are never shuffled.
2. (anchor, context hash, smallest id) per block meet by anchor. An anchor of one document is done.
   If all contexts of an anchor are equal, the smallest id answers for all its strings.
3. Other contexts go to their anchor's bucket as bytes, equal ones once per block. There a suffix
   order (``suffixes``) groups equal strings, and each group's smallest id is the answer.
   An anchor with more than ``HOT`` contexts (a passage pasted into very many places) would make
   one bucket large: its strings go one by one, spread by their own hash and summed per block.
4. Answers return to the blocks, which mark bytes and digest what is left.

A false match of anchors only costs work: contexts decide. Equal contexts are told by 96 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path, stage
from .common import whole_text
from .suffixes import Pieces, equal_windows

SIZE = 50
GRAM = 20
HOT = 4096
BLOCK_BYTES = 8 << 20
BLOCKS_A_BUCKET = 1
MOST_BUCKETS = 20_000
NOBODY = np.iinfo(np.int64).max
_REACH = SIZE - GRAM + 1  # anchors of one string
_SEGMENT = 2 << 20  # bytes looked at together
_MARGIN = 2 * SIZE
_TOGETHER = 8 << 20  # bytes of a batch whose anchors are held at once
_CHUNK = 4000  # contexts in one suffix order
_LOW48 = np.uint64((1 << 48) - 1)

_ANY = np.random.default_rng(5)
_VALUE = _ANY.integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_BASE = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]  # odd, so they have inverses
_BACK = [np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASE]


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _slide(least, x: np.ndarray, width: int) -> np.ndarray:
    """``least`` over every run of ``width`` entries, by doubling."""
    done = 1
    while 2 * done <= width:
        x = least(x[:-done], x[done:])
        done *= 2
    return least(x[: len(x) - (width - done)], x[width - done :]) if done < width else x


@lru_cache
def _powers(which: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base and of its inverse, for a segment with its margins."""
    made = []
    for base in (_BASE[which], _BACK[which]):
        power = np.full(_SEGMENT + 2 * _MARGIN + 1, base, np.uint64)
        power[0] = 1
        made.append(np.cumprod(power))
    return tuple(made)


class Runs:
    """Hashes of any run of a text from prefix sums, modulo 2**64."""

    def __init__(self, data: np.ndarray, which: int = 0):
        power, self.back = _powers(which)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUE[which][data] * power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


class Texts:
    """Documents of a block, end to end, seen in segments."""

    def __init__(self, ids: np.ndarray, texts: pa.Array | pa.ChunkedArray):
        self.ids = ids
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        # the column's own bytes, without a copy
        raw = texts.cast(pa.large_string()) if len(texts) else pa.array([], pa.large_string())
        _, offsets, data = raw.buffers()
        bounds = np.frombuffer(offsets, np.int64)[raw.offset : raw.offset + len(raw) + 1]
        if not len(raw):
            bounds = np.zeros(1, np.int64)
        whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        self.data = whole[bounds[0] : bounds[-1]]
        self.end = bounds[1:] - bounds[0]
        self.start = bounds[:-1] - bounds[0]

    @staticmethod
    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """A batch in slices of about ``_TOGETHER`` bytes of text."""
        size = np.cumsum(pc.binary_length(batch["text"]).to_numpy().astype(np.int64))
        cuts = np.unique(np.searchsorted(size, np.arange(_TOGETHER, int(size[-1:].sum()) + 1, _TOGETHER)))
        for a, b in zip([0, *(cuts + 1)], [*(cuts + 1), len(batch)], strict=True):
            if b > a:
                yield batch.slice(a, b - a)

    def segments(self) -> Iterator[Segment]:
        for first in range(0, len(self.data), _SEGMENT):
            yield Segment(self, first, min(len(self.data), first + _SEGMENT))


class Segment:
    """Anchors of a stretch of a block's text, with their contexts."""

    def __init__(self, texts: Texts, first: int, last: int):
        self.low = low = max(0, first - _MARGIN)
        self.data = data = texts.data[low : last + _MARGIN]
        n = len(data)
        empty = np.zeros(0, np.int64)
        self.place = self.document = self.begin = self.stop = empty
        self.anchor = self.context = empty.astype(np.uint64)
        if n < SIZE:
            return
        # eight bytes from every place on, hashed to the run of GRAM bytes
        padded = np.concatenate([data, np.zeros(GRAM + 8, np.uint8)])
        words = np.ndarray((n + GRAM,), np.uint64, buffer=padded.tobytes(), strides=(1,))
        gram = words[:n] * _BASE[0]
        for step in (8, GRAM - 8):
            gram = _mix(gram + words[step : n + step] * _BASE[1])
        gram |= np.uint64(1)  # zero is kept for strings that cross documents
        smallest = _slide(np.minimum, gram[: n - GRAM + 1], _REACH)
        inside = slice(*np.searchsorted(texts.end, [low, low + n + SIZE]))
        for end in (texts.end[inside] - low).tolist():
            smallest[max(0, end - SIZE + 1) : max(0, end)] = 0
        edge = np.zeros(_REACH - 1, np.uint64)
        chosen = _slide(np.maximum, np.concatenate([edge, smallest, edge]), _REACH)
        place = np.nonzero(chosen == gram[: len(chosen)])[0]
        place = place[(place + low >= first) & (place + low < last)]
        self.place = place
        self.document = np.searchsorted(texts.end, place + low, side="right")
        begin = np.maximum(texts.start[self.document] - low, place - (_REACH - 1))
        self.begin, self.stop = begin, np.minimum(texts.end[self.document] - low, place + SIZE)
        self.anchor = gram[place] >> np.uint64(16)
        self.runs = Runs(data)
        inside = (place - begin).astype(np.uint64)
        self.context = _mix(self.runs.of(begin, self.stop) + inside * _BASE[1]) & _LOW48

    def strings(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(start, document, two hashes) of the strings around some anchors, each start once."""
        first, count = self.begin[which], self.stop[which] - SIZE - self.begin[which] + 1
        owner = np.repeat(np.arange(len(which)), count)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        start, index = np.unique(first[owner] + step, return_index=True)
        document = self.document[which][owner[index]]
        other = Runs(self.data, 1)
        one = self.runs.of(start, start + SIZE) & _LOW48
        return start, document, one, other.of(start, start + SIZE) & _LOW48


def _six(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _first_of(*keys: np.ndarray, also: tuple = ()) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys (the first one first), and where a new combination starts in it.

    ``also`` are columns that the last key stands for: they part rows but do not order them.
    """
    order = np.lexsort(keys[::-1])
    change = np.ones(len(order), bool)
    change[1:] = False
    for key in (*keys, *also):
        sorted_key = key[order]
        change[1:] |= sorted_key[1:] != sorted_key[:-1]
    return order, np.nonzero(change)[0]


def _spread(start: np.ndarray, size: int) -> np.ndarray:
    """Number of the run each of ``size`` places belongs to, from the run starts."""
    out = np.zeros(size, np.int64)
    out[start[1:]] = 1
    return np.cumsum(out)


def _cut_by(values: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Stretches of equal values of a sorted array."""
    edges = np.nonzero(np.append(True, values[1:] != values[:-1]))[0] if len(values) else []
    for a, b in zip(edges, [*edges[1:], len(values)], strict=True):
        yield int(values[a]), slice(a, b)


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


_CLAIMS = "bucket int, block int, anchors binary, contexts binary, ids binary, many binary"


def _claims(buckets: int):
    """Anchors of a batch of documents: the smallest id per (block, anchor, context)."""

    def scan(batches):
        for batch in (part for whole in batches for part in Texts.parts(whole)):
            blocks = batch["block"].to_numpy()
            texts = Texts(batch["id"].to_numpy(), batch["text"])
            parts = [(s.anchor, s.context, s.document) for s in texts.segments()]
            anchor, context, document = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (
                np.zeros(0, np.uint64),
                np.zeros(0, np.uint64),
                np.zeros(0, np.int64),
            )
            block, ids = blocks[document], texts.ids[document]
            bucket = (anchor % np.uint64(buckets)).astype(np.int64)
            goal = bucket * (int(blocks.max(initial=0)) + 1) + block
            order, start = _first_of(goal, _key(anchor, context), also=(anchor, context))
            least = np.minimum.reduceat(ids[order], start) if len(start) else ids[:0]
            most = np.maximum.reduceat(ids[order], start) if len(start) else ids[:0]
            own = order[start]
            out = {k: [] for k in _arrow(_CLAIMS).names}
            for _, part in _cut_by(goal[own]):
                mine = own[part]
                out["bucket"].append(int(bucket[mine[0]]))
                out["block"].append(int(block[mine[0]]))
                out["anchors"].append(_six(anchor[mine]))
                out["contexts"].append(_six(context[mine]))
                out["ids"].append(least[part].astype("<i8").tobytes())
                out["many"].append((most[part] != least[part]).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=_arrow(_CLAIMS))

    return scan


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in ddl.split(", "))])


def _joined(table: pa.Table, *names: str) -> list[bytes]:
    return [b"".join(_column(table, n)) for n in names]


_REPLIES = "block int, kind int, anchors binary, contexts binary, first binary, count binary, ids binary"
SAME, MIXED, HOT_ONE = 0, 1, 2
STRINGS = 3  # an answer for single strings of hot anchors


def _judge(table: pa.Table) -> pa.Table:
    """Anchors of a bucket that several documents hold, back to the blocks that hold them."""
    anchor, context = map(_from_six, _joined(table, "anchors", "contexts"))
    ids = np.frombuffer(_joined(table, "ids")[0], "<i8")
    many = np.frombuffer(_joined(table, "many")[0], np.uint8)
    sizes = [len(x) // 6 for x in _column(table, "anchors")]
    block = np.repeat(np.array(_column(table, "block"), np.int64), sizes)
    out = {n: [] for n in _arrow(_REPLIES).names}
    if len(anchor):
        # most anchors stand once: they go before anything else is sorted
        by = np.argsort(anchor)
        own = anchor[by]
        change = np.append(True, own[1:] != own[:-1])
        twice = by[~(change & np.append(change[1:], True)) | (many[by] > 0)]
        anchor, context, ids, many, block = (x[twice] for x in (anchor, context, ids, many, block))
    if len(anchor):
        order, start = _first_of(anchor, context)
        pair = _spread(start, len(order))
        own = anchor[order]
        head = np.nonzero(np.append(True, own[1:] != own[:-1]))[0]
        group = _spread(head, len(order))
        least = np.minimum.reduceat(ids[order], head)
        several = np.append(pair[head[1:]], pair[-1] + 1) - pair[head]
        most = np.maximum.reduceat(ids[order], head)
        shared = (least != most) | (np.maximum.reduceat(many[order], head) > 0)
        kind = np.where(several == 1, SAME, np.where(several <= HOT, MIXED, HOT_ONE))
        kept = np.nonzero(shared[group])[0]
        again, once = _first_of(block[order][kept], kind[group[kept]], pair[kept])
        mine = kept[again[once]]
        # a block whose one document of the anchor is the smallest holder has nothing to remove
        largest = np.maximum.reduceat(ids[order][kept][again], once) if len(once) else ids[:0]
        more = np.maximum.reduceat(many[order][kept][again], once) if len(once) else many[:0]
        own_only = (kind[group[mine]] == SAME) & (largest == least[group[mine]]) & (more == 0)
        mine = mine[~own_only]
        for _, part in _cut_by(block[order][mine] * 4 + kind[group[mine]]):
            rows = mine[part]
            out["block"].append(int(block[order][rows[0]]))
            out["kind"].append(int(kind[group[rows[0]]]))
            out["anchors"].append(_six(own[rows]))
            out["contexts"].append(_six(context[order][rows]))
            out["first"].append(b"")
            out["count"].append(b"")
            out["ids"].append(least[group[rows]].astype("<i8").tobytes())
    return pa.Table.from_pydict(out, schema=_arrow(_REPLIES))


def _key(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """One number for a pair of hashes."""
    return _mix(one * _BASE[1] + two)


_ASKED = (
    "bucket int, block int, kind int, ones binary, twos binary, ids binary, many binary, sizes binary,"
    " texts binary"
)


def _ask(buckets: int):
    """Contexts (and strings of hot anchors) of a block that cannot be judged from their anchor."""

    def scan(docs: pa.Table, replies: pa.Table) -> pa.Table:
        out = {n: [] for n in _arrow(_ASKED).names}
        if docs.num_rows and replies.num_rows:
            block = docs.column("block")[0].as_py()
            texts = _texts(docs)
            open_ = {k: _of_kind(replies, k) for k in (MIXED, HOT_ONE)}
            found: dict[int, list] = {MIXED: [], HOT_ONE: []}
            for segment in texts.segments():
                key = _key(segment.anchor, segment.context)
                for kind, wanted in open_.items():
                    which = np.nonzero(_in(key, wanted))[0]
                    if not len(which):
                        continue
                    if kind == MIXED:
                        begin, stop = segment.begin[which], segment.stop[which]
                        one, two = segment.anchor[which], segment.context[which]
                        found[kind].append(
                            (one, two, texts.ids[segment.document[which]], begin + segment.low, stop - begin)
                        )
                    else:
                        start, document, one, two = segment.strings(which)
                        found[kind].append(
                            (one, two, texts.ids[document], start + segment.low, np.full(len(start), SIZE))
                        )
            for kind, parts in found.items():
                if not parts:
                    continue
                one, two, ids, begin, size = (np.concatenate(x) for x in zip(*parts, strict=True))
                bucket = (one % np.uint64(buckets)).astype(np.int64)
                order, start = _first_of(bucket, one, two)
                least = np.minimum.reduceat(ids[order], start)
                most = np.maximum.reduceat(ids[order], start)
                own = order[start]
                for number, part in _cut_by(bucket[own]):
                    mine = own[part]
                    out["bucket"].append(number)
                    out["block"].append(block)
                    out["kind"].append(kind)
                    out["ones"].append(_six(one[mine]))
                    out["twos"].append(_six(two[mine]))
                    out["ids"].append(least[part].astype("<i8").tobytes())
                    out["many"].append((most[part] != least[part]).astype(np.uint8).tobytes())
                    out["sizes"].append(size[mine].astype(np.uint8).tobytes())
                    raw = [texts.data[a : a + n].tobytes() for a, n in zip(begin[mine], size[mine], strict=True)]
                    out["texts"].append(b"".join(raw) if kind == MIXED else b"")
        return pa.Table.from_pydict(out, schema=_arrow(_ASKED))

    return scan


def _texts(docs: pa.Table) -> Texts:
    return Texts(docs.column("id").to_numpy(), docs.column("text"))


def _rows_of(table: pa.Table, *kinds: int) -> pa.Table:
    return table.filter(pa.array(np.isin(table.column("kind").to_numpy(), kinds)))


def _of_kind(replies: pa.Table, kind: int) -> np.ndarray:
    """Sorted keys of the replies of a kind."""
    rows = _rows_of(replies, kind)
    return np.sort(_key(*map(_from_six, _joined(rows, "anchors", "contexts"))))


def _in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _answer(table: pa.Table) -> pa.Table:
    """Smallest id of every string of the bucket's contexts, back to the blocks that asked."""
    out = {n: [] for n in _arrow(_REPLIES).names}
    for kind, answer in ((MIXED, _ordered), (HOT_ONE, _summed)):
        rows = _rows_of(table, kind)
        if not rows.num_rows:
            continue
        one, two = map(_from_six, _joined(rows, "ones", "twos"))
        ids = np.frombuffer(_joined(rows, "ids")[0], "<i8")
        many = np.frombuffer(_joined(rows, "many")[0], np.uint8)
        counts = [len(x) // 6 for x in _column(rows, "ones")]
        block = np.repeat(np.array(_column(rows, "block"), np.int64), counts)
        order, start = _first_of(one, two)
        least = np.minimum.reduceat(ids[order], start)
        piece, first, count, smallest = answer(rows, order, start, least, one)
        # a piece's answers, for every block that holds it
        holder = _spread(start, len(order))
        runs = np.searchsorted(piece, holder, side="right") - (begin := np.searchsorted(piece, holder))
        entry = np.repeat(np.arange(len(order)), runs)
        run = np.repeat(begin, runs) + np.arange(len(entry)) - np.repeat(np.cumsum(runs) - runs, runs)
        # a run whose smallest id is the block's one holder of the piece removes nothing there
        useful = (smallest[run] < ids[order][entry]) | (many[order][entry] > 0)
        entry, run = entry[useful], run[useful]
        to = block[order][entry]
        again = np.argsort(to, kind="stable")
        entry, run, to = entry[again], run[again], to[again]
        for number, part in _cut_by(to):
            mine = order[entry[part]]
            out["block"].append(number)
            out["kind"].append(MIXED if kind == MIXED else STRINGS)
            out["anchors"].append(_six(one[mine]))
            out["contexts"].append(_six(two[mine]))
            out["first"].append(first[run[part]].astype(np.uint8).tobytes())
            out["count"].append(count[run[part]].astype(np.uint8).tobytes())
            out["ids"].append(smallest[run[part]].astype("<i8").tobytes())
    return pa.Table.from_pydict(out, schema=_arrow(_REPLIES))


def _summed(rows, order, start, least, one):
    """Single strings: the piece is the string."""
    piece = np.arange(len(start))
    return piece, np.zeros(len(start), np.int64), np.ones(len(start), np.int64), least


def _ordered(rows, order, start, least, one):
    """Runs (piece, first string, strings, smallest id) from suffix orders over whole anchors."""
    size = np.frombuffer(_joined(rows, "sizes")[0], np.uint8).astype(np.int64)
    raw = _joined(rows, "texts")[0]
    begin = np.cumsum(size) - size
    own = order[start]
    texts = [raw[a : a + n] for a, n in zip(begin[own].tolist(), size[own].tolist(), strict=True)]
    heads = np.nonzero(np.append(True, one[own][1:] != one[own][:-1]))[0]
    found = []
    at = 0
    while at < len(texts):
        # whole anchors only; one has HOT contexts at most
        later = heads[heads > at]
        fits = later[later <= at + _CHUNK]
        end = int(fits[-1]) if len(fits) and len(texts) - at > _CHUNK else (
            len(texts) if len(texts) - at <= _CHUNK or not len(later) else int(later[0])
        )
        row, column, group = equal_windows(Pieces(texts[at:end]), SIZE)
        if len(row):
            edges = np.nonzero(np.append(True, group[1:] != group[:-1]))[0]
            smallest = np.minimum.reduceat(least[at + row], edges)[group]
            order_ = np.lexsort((column, row))
            row, column, smallest = row[order_], column[order_], smallest[order_]
            new = np.append(True, (row[1:] != row[:-1]) | (smallest[1:] != smallest[:-1]))
            heads_ = np.nonzero(new)[0]
            count = np.diff(np.append(heads_, len(row)))
            found.append((at + row[heads_], column[heads_], count, smallest[heads_]))
        at = end
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


_RESULT = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _mark(with_text: bool):
    """Per document of a block: what is removed, and the digest of what is left."""

    def scan(docs: pa.Table, replies: pa.Table) -> pa.Table:
        schema = _arrow(_RESULT + (", kept binary" if with_text else ""))
        out = {n: [] for n in schema.names}
        texts = _texts(docs)
        n = len(texts.data)
        marks = np.zeros(n + 1, np.int32)
        if n and replies.num_rows:
            rows = _rows_of(replies, SAME, MIXED).filter(
                pa.array(
                    [
                        k == SAME or len(x) > 0
                        for r in [_rows_of(replies, SAME, MIXED)]
                        for k, x in zip(_column(r, "kind"), _column(r, "first"), strict=True)
                    ],
                    pa.bool_(),
                )
            )
            runs = _Answers(rows)
            hot, strings = _of_kind(replies, HOT_ONE), _Answers(_rows_of(replies, STRINGS))
            for segment in texts.segments():
                key = _key(segment.anchor, segment.context)
                which, first, count, smallest = runs.find(key)
                reach = segment.stop[which] - segment.begin[which] - SIZE + 1
                count = np.where(count == 0, reach, count)
                gone = smallest < texts.ids[segment.document[which]]
                start = segment.begin[which][gone] + segment.low + first[gone]
                np.add.at(marks, start, 1)
                np.add.at(marks, start + count[gone] - 1 + SIZE, -1)
                which = np.nonzero(_in(key, hot))[0]
                if len(which):
                    place, document, one, two = segment.strings(which)
                    found, _, _, smallest = strings.find(_key(one, two))
                    gone = smallest < texts.ids[document[found]]
                    start = place[found][gone] + segment.low
                    np.add.at(marks, start, 1)
                    np.add.at(marks, start + SIZE, -1)
        removed = np.cumsum(marks[:-1]) > 0
        for i in range(docs.num_rows):
            a, b = int(texts.start[i]), int(texts.end[i])
            own, body = removed[a:b], texts.data[a:b]
            count = int(own.sum())
            kept = body.tobytes() if not count else body[~own].tobytes()
            out["id"].append(int(texts.ids[i]))
            out["n_bytes"].append(b - a)
            out["n_removed"].append(count)
            out["n_spans"].append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()) if count else 0)
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if with_text:
                out["kept"].append(kept)
        return pa.Table.from_pydict(out, schema=schema)

    return scan


class _Answers:
    """Runs of replies by key; a count of zero stands for all strings of a context."""

    def __init__(self, rows: pa.Table):
        key = _key(*map(_from_six, _joined(rows, "anchors", "contexts")))
        ids = np.frombuffer(_joined(rows, "ids")[0], "<i8")
        first, count = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        at = 0
        for kind, anchors, one, n in zip(*(_column(rows, c) for c in ("kind", "anchors", "first", "count")), strict=True):
            size = len(anchors) // 6
            if kind != SAME:
                first[at : at + size] = np.frombuffer(one, np.uint8)
                count[at : at + size] = np.frombuffer(n, np.uint8)
            at += size
        order = np.argsort(key, kind="stable")
        self.key, self.first, self.count, self.ids = key[order], first[order], count[order], ids[order]

    def find(self, keys: np.ndarray):
        """(which key, first, count, id) of every run of every key."""
        low = np.searchsorted(self.key, keys)
        runs = np.searchsorted(self.key, keys, side="right") - low
        which = np.repeat(np.arange(len(keys)), runs)
        run = np.repeat(low, runs) + np.arange(len(which)) - np.repeat(np.cumsum(runs) - runs, runs)
        return which, self.first[run], self.count[run], self.ids[run]


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    block_bytes: int = BLOCK_BYTES,
    with_text: bool = False,
) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of every row, and ``kept`` bytes if asked.

    A byte is removed if a string of ``SIZE`` bytes covers it that also starts in a row with a
    smaller id; strings are judged on the input and never cross rows. Null and empty texts have no
    bytes. Rows with one id do not remove from each other, so repeated rows repeat their result.
    Null ids count as larger than all ids. Other columns are ignored; an empty table gives an
    empty table. ``kept`` may cut a character in two, as the strings are bytes.
    """
    spark = docs.sparkSession
    text = whole_text(text_column)
    plain = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NOBODY)).alias("id"), text.alias("text")
    )
    total = plain.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(BLOCKS_A_BUCKET, -(-total // block_bytes))
    buckets = min(MOST_BUCKETS, -(-blocks // BLOCKS_A_BUCKET))
    placed = plain.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    path = scratch_path(spark, "blocks")
    name = "blocks_" + path.rsplit("-", 1)[1]
    stored_as = placed.write.bucketBy(buckets, "block").option("compression", "zstd")
    stored_as.option("path", path).saveAsTable(name)
    stored = spark.table(name)

    claims = stored.mapInArrow(_claims(buckets), _CLAIMS)
    replies = stage(claims.groupBy("bucket").applyInArrow(_judge, _REPLIES), "replies")
    asked = (
        stored.groupBy("block")
        .cogroup(replies.where(F.col("kind") != SAME).groupBy("block"))
        .applyInArrow(_ask(buckets), _ASKED)
    )
    answers = asked.groupBy("bucket").applyInArrow(_answer, _REPLIES)
    marked = (
        stored.groupBy("block")
        .cogroup(replies.union(answers).groupBy("block"))
        .applyInArrow(_mark(with_text), _RESULT + (", kept binary" if with_text else ""))
    )
    owner = F.when(F.col("id") != NOBODY, F.col("id")).alias(id_column)
    return marked.select(owner, *[c for c in marked.columns if c != "id"])
