"""Context-mixing range coder for token ids, many blocks at a time.

A file image holds ids in blocks of ``BLOCK``. Each block starts from the same fresh model, which
the image's header tells, and has its own checksum, so any block can be read with the header alone,
and damage stays in its block. Three predictions drive the coder:

- order 2: the id that follows the two ids before, with a confidence of 0 to 3;
- order 1: the same for the one id before;
- order 0: how often each id occurs.

The header tells of all ids of the image how often each occurs and what follows what most often. From
there on a block learns: orders 2 and 1 after every id, an id that keeps failing giving way to the one
that came, and the weights of the predictions, for each pair of confidences and for agreeing and
differing predictions, every ``_PAUSE`` ids. The mixed distribution gives every id
an interval, and a range coder narrows its own interval to it. All arithmetic is on whole numbers, so
every machine reads what another wrote.

The blocks of an image are lanes of numpy arrays: step ``t`` codes the ``t``-th id of every block.
Only the last block may be short; it is the last lane and drops out early. At most ``_TOGETHER`` blocks
are coded at a time, so that what they learn takes bounded room. Ids are coded as their
place among the different ids of the image. A step makes at most one word of output in a lane, so all
lanes take the same few operations.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 2048
MOST_IDS = 1 << 19  # with more, or longer blocks, an id's interval could be empty
MAGIC = b"GSTI"
VERSION = 3
# magic, version, vocabulary, block, documents, ids, blocks, bytes of the model
_HEAD = struct.Struct("<4sBIIIQII")

_MASS = np.uint64(30)  # bits of the whole mixed distribution
_WHOLE = np.int32(1 << 30)
_LEAST = np.uint64(1 << 31)  # the interval is never narrower, and has 63 bits; the 64th is carried
_LOWER = np.uint64((1 << 32) - 1)
_SURE, _RARE = 63488, 256  # bounds of a chance, of 65536: nothing is impossible or certain
_CELLS = 32  # weights that are learned apart
_PRIOR = 32  # ids that a weight to begin with counts as
_BEGIN = np.array([1, 4, 12, 22], np.int32)  # how many of them a prediction gets right, by confidence
_PAUSE = 64  # ids between two updates of the weights
_TOGETHER = 4096  # blocks that are coded at a time
_SHARE = 128  # ids for each context of order 2
_SPREAD = 40503
_SCATTER = 2654435761
# by confidence, and again for a prediction that was right: what is added to it, 2 where it gives way
_STEPS = np.array([2, -1, -1, -1, 1, 1, 1, 0], np.int32)


class BadBlock(ValueError):
    """A file image that is cut, changed or of another kind."""


def _followers(contexts: np.ndarray, after: np.ndarray, n_contexts: int, n_places: int) -> np.ndarray:
    """For every context, 4 times the place that follows it most often, and the confidence in it."""
    pairs = contexts * n_places + after
    if n_contexts * n_places <= 1 << 32:
        pairs = pairs.astype(np.uint32)
    pairs.sort()
    first = np.flatnonzero(np.concatenate([[True], pairs[1:] != pairs[:-1]]))
    times = np.diff(first, append=len(pairs))
    held, place = np.divmod(pairs[first].astype(np.int64), n_places)
    begin = np.flatnonzero(np.diff(held, prepend=-1))
    most = np.maximum.reduceat(times * n_places + place, begin)  # the highest place of several
    most, place = np.divmod(most, n_places)
    every = np.add.reduceat(times, begin)
    sure = (most > 1) * (1 + (4 * most > every) + (2 * most > every))
    entries = np.zeros(n_contexts, np.int32)
    entries[held[begin]] = place * 4 + sure
    return entries


class _Model:
    """What an image's header tells: its ids, their shares, and what follows what."""

    def __init__(self, ids: np.ndarray, shares: np.ndarray, one: np.ndarray, two: np.ndarray):
        self.ids = ids.astype(np.int64)
        self.shares, self.one, self.two = (x.astype(np.int32) for x in (shares, one, two))
        self.begun = (np.cumsum(self.shares) - self.shares).astype(np.int32)
        self.bits = int(shares.sum()).bit_length() - 1
        self.mask = len(two) - 1

    @classmethod
    def of(cls, ids: np.ndarray, vocabulary: int) -> tuple[_Model, np.ndarray]:
        """The model of the ids, and the place of each."""
        seen = np.bincount(ids, minlength=vocabulary)
        different = np.flatnonzero(seen)
        place = np.zeros(vocabulary, np.int32)
        place[different] = np.arange(len(different))
        seen = seen[different]
        bits = min(len(different).bit_length() + 3, 20)
        shares = 1 + seen * ((1 << bits) - len(different)) // len(ids)
        shares[np.argmax(seen)] += (1 << bits) - int(shares.sum())
        now = place[ids]
        n_two = 1 << max(len(ids) // _SHARE, 1).bit_length()
        one = np.zeros(len(different), np.int32)
        two = np.zeros(n_two, np.int32)
        if len(ids) > 2:
            last = now[:-1].astype(np.int64)
            one = _followers(last, now[1:], len(different), len(different))
            slots = (last[1:] + last[:-1] * _SPREAD) & (n_two - 1)
            two = _followers(slots, now[2:], n_two, len(different))
        return cls(different, shares, one, two), now

    def told(self, older: np.ndarray, last: np.ndarray) -> np.ndarray:
        """What the header says by order 2, and by order 1."""
        return np.stack([self.two.take((last + older * _SPREAD) & self.mask), self.one.take(last)])

    def pack(self) -> bytes:
        steps = np.diff(self.ids, prepend=0)
        sizes = [len(steps), len(self.two)]
        table = np.concatenate([sizes, steps, self.shares, self.one, self.two])
        return zlib.compress(table.astype("<u4").tobytes(), 1)

    @classmethod
    def unpack(cls, packed: bytes, vocabulary: int) -> _Model:
        try:
            table = np.frombuffer(zlib.decompress(packed), "<u4").astype(np.int64)
            n, n_two = (int(x) for x in table[:2])
            steps, shares, one, two = np.split(table[2:], np.cumsum([n, n, n]))
            model = cls(np.cumsum(steps), shares, one, two)
        except (zlib.error, ValueError) as error:
            raise BadBlock("the model is damaged") from error
        fits = n and 0 < n_two == len(two) and not n_two & (n_two - 1) and model.ids[-1] < vocabulary
        fits = fits and shares.min() > 0 and model.bits <= 20 and shares.sum() == 1 << model.bits
        if not fits or max(one.max(), two.max()) >= 4 * n:
            raise BadBlock("the model is not one")
        return model


class _Learned:
    """What every lane has learned by orders 2 and 1, in place of what the header says."""

    def __init__(self, lanes: int, block: int):
        bits = (block - 1).bit_length()
        self.shift, self.mask = 32 - bits, (1 << bits) - 1
        self.base = (np.arange(2 * lanes, dtype=np.int64) << bits).reshape(2, lanes)
        self.held = np.full(2 * lanes << bits, -1, np.int32)  # nothing so far

    def slots(self, older: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Where the entries of contexts lie: order 2, order 1."""
        pair = np.stack([last * _SPREAD + older, last]) * _SCATTER
        pair >>= self.shift
        pair &= self.mask
        pair += self.base[:, None, : last.shape[-1]] if last.ndim > 1 else self.base[:, : len(last)]
        return pair

    def say(self, at: np.ndarray, told: np.ndarray) -> np.ndarray:
        """4 times the place that is predicted, and the confidence."""
        held = self.held.take(at)
        return np.where(held < 0, told, held)

    def learn(self, at: np.ndarray, said: np.ndarray, now: np.ndarray) -> None:
        """``now``: 4 times the place that came. A prediction that fails without confidence gives way."""
        step = _STEPS.take((said & 3) + (((said ^ now) < 4) << 2))
        self.held[at] = np.where(step == 2, now, said + step)


def _cells(said: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places that orders 2 and 1 say, and the cell of their weights."""
    sure, (two, one) = said & 3, said >> 2
    cell = (sure[0] << 3) + (sure[1] << 1)
    cell += two != one
    return two, one, cell


class _Weights:
    """What has been learned so far in every lane about the predictions."""

    def __init__(self, lanes: int, bits: int):
        self.bits = bits
        self.base = np.arange(lanes, dtype=np.int64) * _CELLS
        cell = np.arange(_CELLS)
        right2 = _BEGIN[cell >> 3]
        right1 = (_PRIOR - right2) * _BEGIN[(cell >> 1) & 3] // _PRIOR
        begin = (np.full(_CELLS, _PRIOR), right2, right1, cell & 1)
        begin = [np.tile(x.astype(np.uint32), lanes) for x in begin]
        self.every, self.right2, self.right1, self.differ = begin
        self._settle()

    def _settle(self) -> None:
        chance2 = np.clip((self.right2 << 16) // self.every, _RARE, _SURE)
        chance1 = np.clip((self.right1 << 16) // (self.every - self.right2), _RARE, _SURE)
        self.chances = (chance2 << 16) | (chance1 * self.differ)

    def sizes(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Interval sizes of order 2 and of both orders, and the unit of order 0, for lanes and cells."""
        chance = self.chances.take(at)
        size2 = ((chance >> 16) << 14).view(np.int32)
        both = size2 + ((_WHOLE - size2) >> 16) * (chance & 65535).view(np.int32)
        return size2, both, (_WHOLE - both) >> self.bits

    def learn(self, at: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """``at``: lane and cell of every id; ``hit1``: order 1 says it, and order 2 does not."""
        for count, which in ((self.every, at), (self.right2, at[hit2]), (self.right1, at[hit1])):
            count += np.bincount(which, minlength=len(count)).astype(np.uint32)
        self._settle()


def _lanes(n_ids: int, block: int) -> tuple[int, int]:
    """Number of blocks, and how many ids the last one holds."""
    lanes = -(-n_ids // block)
    return lanes, n_ids - (lanes - 1) * block if lanes else 0


def _stretches(lanes: int, short: int, block: int):
    """First and last step, and the lanes that take part in each stretch between two updates."""
    edges = sorted({*range(0, block, _PAUSE), short, block})
    for begin, end in zip(edges, edges[1:]):
        n = lanes if end <= short else lanes - 1
        if n:
            yield begin, end, n


def encode_blocks(places: np.ndarray, model: _Model, block: int = BLOCK) -> list[bytes]:
    """The places of ids as coded blocks; each but the last holds ``block``."""
    some = _TOGETHER * block
    return [b for i in range(0, len(places), some) for b in _encode(places[i : i + some], model, block)]


def _encode(places: np.ndarray, model: _Model, block: int) -> list[bytes]:
    lanes, short = _lanes(len(places), block)
    table = np.zeros(lanes * block, np.int32)
    table[: len(places)] = places
    steps = np.zeros((block + 2, lanes), np.int32)  # after two of place 0
    steps[2:] = table.reshape(lanes, block).T
    weights, learned = _Weights(lanes, model.bits), _Learned(lanes, block)
    low = np.zeros(lanes, np.uint64)
    wide = np.full(lanes, (1 << 63) - 1, np.uint64)
    out = np.zeros((block + 2) * lanes, np.uint64)  # a row of words of all lanes after the other
    ends = np.arange(lanes)
    for begin, end, n in _stretches(lanes, short, block):
        known = steps[begin : end + 2, :n].astype(np.int64)
        now = known[2:]
        told = model.told(known[:-2], known[1:-1])
        slots = learned.slots(known[:-2], known[1:-1])
        came = steps[begin + 2 : end + 2, :n] << 2
        for k in range(end - begin):
            told[:, k] = said = learned.say(slots[:, k], told[:, k])
            learned.learn(slots[:, k], said, came[k])
        two, one, cell = _cells(told)
        at = cell + weights.base[:n]
        hit2 = now == two
        hit1 = (now == one) & ~hit2
        size2, both, unit = weights.sizes(at)
        start = np.where(hit1, size2, both + unit * model.begun.take(now))
        start = (start * ~hit2).astype(np.uint64)
        size = np.where(hit1, both - size2, unit * model.shares.take(now))
        size = np.where(hit2, size2, size).astype(np.uint64)
        weights.learn(at.ravel(), hit2.ravel(), hit1.ravel())
        a, b, to = low[:n], wide[:n], ends[:n]
        for k in range(end - begin):
            part = b >> _MASS
            a = a + part * start[k]
            b = part * size[k]
            out[to] = a >> np.uint64(31)  # stays only where the interval has become narrow
            once = (b < _LEAST).astype(np.uint64)
            shift = once << np.uint64(5)
            a = (a & ~(once << np.uint64(31))) << shift
            b = b << shift
            to = to + once.view(np.int64) * lanes
        low[:n], wide[:n], ends[:n] = a, b, to
    out[ends] = low >> np.uint64(31)  # the whole of low ends a block
    out[ends + lanes] = (low << np.uint64(1)) & _LOWER
    lengths = ends // lanes + 2
    words = out.reshape(-1, lanes)[: int(lengths.max())]
    words[np.arange(len(words))[:, None] >= lengths] = 0
    for k in range(len(words) - 1, 0, -1):  # what a word carries is added to the one before
        words[k - 1] += words[k] >> np.uint64(32)
    plain = (words & _LOWER).T.astype("<u4")
    return [plain[i, : lengths[i]].tobytes() for i in range(lanes)]


def decode_blocks(blocks: list[bytes], n_ids: int, model: _Model, block: int = BLOCK) -> np.ndarray:
    """The ids of all blocks, in order."""
    lengths = np.array([len(b) for b in blocks], np.int64)
    if _lanes(n_ids, block)[0] != len(blocks) or (lengths % 4).any():
        raise BadBlock("the number or size of blocks is not that of the ids")
    parts = [
        _decode(blocks[i : i + _TOGETHER], min(n_ids - i * block, _TOGETHER * block), model, block)
        for i in range(0, len(blocks), _TOGETHER)
    ]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def _decode(blocks: list[bytes], n_ids: int, model: _Model, block: int) -> np.ndarray:
    lanes, short = _lanes(n_ids, block)
    lengths = np.array([len(b) for b in blocks], np.int64)
    longest = int(lengths.max()) // 4
    even = b"".join([b.ljust(4 * longest, b"\0") for b in blocks])
    rows = np.zeros((longest + 2, lanes), np.uint64)  # a row of words of all lanes after the other
    rows[:longest] = np.frombuffer(even, "<u4").reshape(lanes, -1).T
    code = (rows[0] << np.uint64(31)) | (rows[1] >> np.uint64(1))  # above the interval's lower end
    words = np.zeros((longest + block + 2) * lanes, np.uint64)  # as code needs them, with room for damaged ones
    words[: (longest + 1) * lanes] = (((rows[:-1] << np.uint64(31)) & _LOWER) | (rows[1:] >> np.uint64(1))).ravel()
    wide = np.full(lanes, (1 << 63) - 1, np.uint64)
    ends = np.arange(lanes) + lanes
    weights, learned = _Weights(lanes, model.bits), _Learned(lanes, block)
    which = np.repeat(np.arange(len(model.ids), dtype=np.int32), model.shares)
    most = len(which) - 1
    steps = np.zeros((block + 2, lanes), np.int64)
    for begin, end, n in _stretches(lanes, short, block):
        c, b, to, base = code[:n], wide[:n], ends[:n], weights.base[:n]
        older, last = steps[begin, :n], steps[begin + 1, :n]
        seen, hits2, hits1 = [], [], []
        for k in range(begin, end):
            slots = learned.slots(older, last)
            said = learned.say(slots, model.told(older, last))
            two, one, cell = _cells(said)
            at = cell + base
            size2, both, unit = weights.sizes(at)
            part = b >> _MASS
            value = (c // part).astype(np.int32)
            hit2, hit12 = value < size2, value < both
            share = (value - both).view(np.uint32) // unit.view(np.uint32)
            now = which.take(np.minimum(share, most))
            start = np.where(hit12, size2, both + unit * model.begun.take(now)) * ~hit2
            size = np.where(hit12, both - size2, unit * model.shares.take(now))
            size = np.where(hit2, size2, size)
            now = np.where(hit2, two, np.where(hit12, one, now))
            learned.learn(slots, said, now << 2)
            c = c - part * start.astype(np.uint64)
            b = part * size.astype(np.uint64)
            once = (b < _LEAST).astype(np.uint64)
            shift = once << np.uint64(5)
            c = (c << shift) | (words.take(to) * once)
            b = b << shift
            to = to + once.view(np.int64) * lanes
            steps[k + 2, :n] = now
            older, last = last, steps[k + 2, :n]
            seen.append(at)
            hits2.append(hit2)
            hits1.append(hit12 ^ hit2)
        code[:n], wide[:n], ends[:n] = c, b, to
        weights.learn(np.concatenate(seen), np.concatenate(hits2), np.concatenate(hits1))
    return model.ids.take(steps[2:].T.reshape(-1)[:n_ids])


def pack(
    doc_ids: list[int | None], counts: list[int], ids: np.ndarray, vocabulary: int, block: int = BLOCK
) -> bytes:
    """A file image: header with its model, documents, blocks with their checksums, coded ids."""
    if not (0 < vocabulary <= MOST_IDS and 0 < block <= BLOCK):
        raise ValueError("the vocabulary or the blocks are too large for the coder")
    told, coded = b"", []
    if len(ids):
        if int(ids.max()) >= vocabulary or int(ids.min()) < 0:
            raise ValueError("an id is outside the vocabulary")
        model, places = _Model.of(ids, vocabulary)
        told, coded = model.pack(), encode_blocks(places, model, block)
    plain = ids.astype("<u4").tobytes()
    sums = [zlib.crc32(plain[4 * i * block : 4 * (i + 1) * block]) for i in range(len(coded))]
    head = _HEAD.pack(
        MAGIC, VERSION, vocabulary, block, len(doc_ids), len(ids), len(coded), len(told)
    ) + b"".join(
        (
            np.array([d is None for d in doc_ids], "u1").tobytes(),
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            np.array(counts, "<u4").tobytes(),
            np.array([len(c) for c in coded], "<u4").tobytes(),
            np.array(sums, "<u4").tobytes(),
            told,
        )
    )
    return b"".join([head, struct.pack("<I", zlib.crc32(head)), *coded])


def unpack(image: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, ids per document, and all ids of a file image; its checksums must hold."""
    if len(image) < _HEAD.size:
        raise BadBlock("the file ends in its header")
    magic, version, vocabulary, block, n_docs, n_ids, n_blocks, n_told = _HEAD.unpack_from(image)
    if magic != MAGIC or version != VERSION:
        raise BadBlock("not a token file of this version")
    at = _HEAD.size
    size = at + 13 * n_docs + 8 * n_blocks + n_told
    if len(image) < size + 4 or struct.unpack_from("<I", image, size)[0] != zlib.crc32(image[:size]):
        raise BadBlock("the header is damaged")

    def column(kind: str, n: int) -> np.ndarray:
        nonlocal at
        values = np.frombuffer(image, kind, n, at)
        at += values.nbytes
        return values

    absent, names = column("u1", n_docs), column("<i8", n_docs)
    counts, lengths, sums = column("<u4", n_docs), column("<u4", n_blocks), column("<u4", n_blocks)
    edges = size + 4 + np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    if edges[-1] != len(image) or int(counts.sum(dtype=np.int64)) != n_ids:
        raise BadBlock("the file is cut or longer than its tables say")
    ids = np.zeros(0, np.int64)
    if n_ids:
        blocks = [image[edges[i] : edges[i + 1]] for i in range(n_blocks)]
        ids = decode_blocks(blocks, n_ids, _Model.unpack(image[at : at + n_told], vocabulary), block)
    plain = ids.astype("<u4").tobytes()
    for i in range(n_blocks):
        if zlib.crc32(plain[4 * i * block : 4 * (i + 1) * block]) != sums[i]:
            raise BadBlock(f"block {i} is damaged")
    known = [None if a else int(d) for a, d in zip(absent, names, strict=True)]
    return known, counts.astype(np.int64), ids
