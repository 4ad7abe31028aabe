"""Token ids of a corpus in compressed binary files, written and read by Spark.

Documents are range-partitioned by id, so the order of the files is that of the documents, and a
task tokenises and codes its own stretch (:mod:`token_coder` has the file format). A file image is
one row of a Parquet folder: Spark commits each task's files once, on any storage, however often a
task is tried, and one image is all that a reader needs.

Nothing but one number per task travels to find where a document starts: an image knows how many
ids its task wrote before it, and a task's own offset is a running sum over the tasks.

Null texts are empty; the end id is appended to every document, so each has at least one id. Ids
may be null (first in order) or repeated; documents with one id are in order of their text's hash,
then their text, and equal rows are equal. An empty table gives an empty folder. Extra columns are
not read. Every text goes to the tokenizer whole, also one that came before, and an image grows with a
single long text. ``by_piece`` looks up pieces of texts that were met before instead: the same ids,
for less time the more often words come again.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import whole_text
from .token_coder import pack, unpack

FILE_IDS = 1 << 22  # an image is closed when it holds as many
TEXT_BYTES = 1 << 22  # texts that are cut into pieces in one go
WHOLE_BYTES = 1 << 20  # texts that are tokenised in one go; the tokenizer holds far more of each
KNOWN_PIECES = 1 << 20  # pieces that a worker remembers
_CALL_BYTES = 1 << 16  # new pieces that the tokenizer takes as one text

# kinds of bytes; other bytes are 0, and so are all of a character that is not known to be a letter
_LETTER, _DIGIT, _SIGN, _QUOTE, _BLANK, _SPACE = range(1, 7)
_TWO_BYTE_LETTERS = (0xC3, 0xC4, 0xC5, 0xD0, 0xD1)  # first bytes; all letters but two signs of C3

_IMAGES = "part LONG, number LONG, before LONG, n_ids LONG, image BINARY"
_ROWS = "doc_id LONG, part LONG, within LONG, n_tokens LONG, ids BINARY"


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


def _tables() -> tuple[bytes, bytes, bytes]:
    """By byte: its kind, and which wide characters it may begin; by two kinds: whether to cut between."""
    kind = np.zeros(256, np.uint8)
    for byte in range(128):
        sign = chr(byte)
        if sign.isspace():
            kind[byte] = _BLANK if sign in " \n" else _SPACE
        elif sign.isprintable():
            kind[byte] = _LETTER if sign.isalpha() else _DIGIT if sign.isdigit() else _SIGN
    kind[ord("'")] = _QUOTE
    kind[list(_TWO_BYTE_LETTERS)] = _LETTER
    wide = np.zeros(256, np.uint8)
    wide[[0xC2, 0xE1, 0xE2, 0xE3]] = _SPACE
    wide[list(_TWO_BYTE_LETTERS)] = _LETTER
    cut = np.zeros((32, 8), bool)
    cut[: _BLANK, _BLANK] = True  # a blank after anything but white space
    for one in (_LETTER, _DIGIT, _SIGN):
        for other in (_LETTER, _DIGIT, _SIGN):
            cut[one, other] = one != other
    cut[[_LETTER, _DIGIT], _QUOTE] = True
    return kind.tobytes(), wide.tobytes(), cut.tobytes()


_KIND, _WIDE, _CUT = _tables()
_WIDE_SPACES = np.array(
    [int.from_bytes(chr(c).encode(), "big") for c in range(128, 1 << 16) if chr(c).isspace() or c == 0x180E]
)


def _kinds(data: np.ndarray) -> np.ndarray:
    """The kind of every byte of UTF-8 text."""
    plain = data.tobytes()
    kind = np.frombuffer(bytearray(plain.translate(_KIND)), np.uint8)
    if plain.isascii():
        return kind
    wide = np.frombuffer(plain.translate(_WIDE), np.uint8)
    at = np.flatnonzero(wide == _LETTER)
    second = data[at + 1]
    letter = (data[at] != 0xC3) | ((second != 0x97) & (second != 0xB7))
    kind[at] = kind[at + 1] = letter * np.uint8(_LETTER)
    at = np.flatnonzero(wide == _SPACE)
    if len(at):
        longer = data[at] != 0xC2
        last = at + 1 + longer
        sign = data[at].astype(np.int64) << 8 | data[at + 1]
        sign = np.where(longer, sign << 8 | data[last], sign)
        kind[last[np.isin(sign, _WIDE_SPACES)]] = _SPACE
    return kind


def _piece_starts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin that begin at ``starts``."""
    kind = _kinds(data)
    cut = np.zeros(len(data), bool)
    cut[1:] = np.frombuffer(((kind[:-1] << 3) | kind[1:]).tobytes().translate(_CUT), bool)
    cut[starts[starts < len(data)]] = True
    # a line feed that is a piece's first byte is a piece of its own, if what follows is no white space
    feeds = np.flatnonzero((data[:-1] == 10) & cut[:-1])
    after = kind[feeds + 1]
    cut[feeds[(after > 0) & (after < _BLANK)] + 1] = True
    return np.flatnonzero(cut)


def _bytes_of(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of texts, and where each begins, and the last ends."""
    _, offsets, data = array.buffers()
    edges = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[edges[0] : edges[-1]], edges - edges[0]


class _Encoder:
    """Ids of whole texts, each different piece of a text tokenised once.

    A byte-level tokenizer that splits at white space in front of words (and changes no text before)
    gives a text the ids of its pieces, cut where a space or line feed follows anything but white
    space, where letters, digits and signs meet, and after a single line feed: no token reaches over
    such a place, and no rule looks back over it. After an apostrophe nothing is cut, as it may begin
    a word's ending, nor beside characters of a kind that is not known here. The pieces of a text are
    looked up among those met before; new ones go to the tokenizer, many in one text where what
    stands beside them is such a place. Any other tokenizer gets whole texts.
    """

    def __init__(self, path: str, by_piece: bool = True):
        self.tokenizer = _tokenizer(path)
        rules = json.loads(self.tokenizer.to_str())
        splitter = rules["pre_tokenizer"] or {}
        self.by_piece = (
            by_piece
            and rules["normalizer"] is None
            and splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space")
            and not rules["model"].get("dropout")
            and not rules["truncation"]
            and not rules["padding"]
            and all(token["special"] for token in rules["added_tokens"])
        )
        words = self.tokenizer.get_vocab()
        self.widths = np.zeros(max(words.values()) + 1, np.int64)  # a byte is one character of a token
        self.widths[list(words.values())] = [len(word) for word in words]
        self.known: dict[bytes, int] = {}
        self.ids = np.zeros(0, np.int32)  # of all known pieces, one after the other
        self.starts, self.counts = np.zeros((2, 0), np.int64)
        self.met = np.zeros(0, np.int64)  # how many groups of texts held a piece

    def _forget(self) -> None:
        """Forget the pieces that were met once, or all, if that leaves over half of the room."""
        stay = self.met > 1
        if int(stay.sum()) > KNOWN_PIECES // 2:
            stay[:] = False
        kept = np.flatnonzero(stay)
        self.known = {p: i for i, p in enumerate(p for p, n in self.known.items() if stay[n])}
        self.ids = self.ids[np.repeat(stay, self.counts)]
        self.counts = self.counts[kept]
        self.starts = np.cumsum(self.counts) - self.counts
        self.met = np.zeros(len(kept), np.int64)

    def _coded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The tokenizer's ids of texts, and how many each has."""
        ids = [c.ids for c in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.array([len(i) for i in ids], np.int64)
        return np.fromiter(chain.from_iterable(ids), np.int32, int(counts.sum())), counts

    def _joined(self, pieces: list[bytes], between: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The same for pieces between which ``between`` may stand in a text."""
        widths = np.fromiter(map(len, pieces), np.int64, len(pieces)) + len(between)
        edges = np.concatenate([[0], np.cumsum(widths)])
        calls = np.flatnonzero(np.diff(edges // _CALL_BYTES, prepend=-1, append=-1)[:-1])
        calls = [*calls[calls < len(pieces)].tolist(), len(pieces)]
        texts = [between.join([*pieces[a:b], b""]).decode() for a, b in zip(calls, calls[1:])]
        ids, _ = self._coded(texts)
        ends = np.cumsum(self.widths[ids])
        last = edges[1:] - len(between)
        begun = np.searchsorted(ends, edges[:-1], "right")
        until = np.searchsorted(ends, last, "right")
        whole = len(ids) and ends[-1] == edges[-1] and np.array_equal(ends[until - 1], last)
        if not whole or not np.array_equal(ends[begun[1:] - 1], edges[1:-1]):
            return self._coded([p.decode() for p in pieces])
        if between:
            inside = np.zeros(len(ids) + 1, np.int8)
            inside[begun] += 1
            inside[until] -= 1
            ids = ids[np.cumsum(inside[:-1]) > 0]
        return ids, until - begun

    def _learn(self, pieces: list[bytes]) -> np.ndarray:
        """Tokenise new pieces; their numbers."""
        numbers = np.zeros(len(pieces), np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        begin = np.concatenate([[0], ends[:-1]])
        kind = _kinds(data)
        first, last = kind[begin], kind[ends - 1]
        words = (last == _LETTER) | (last == _DIGIT)
        spaced = words & (data[begin] == 32)
        bare = words & ((first == _LETTER) | (first == _DIGIT))
        for some, between in ((spaced, b""), (bare, b"."), (~(spaced | bare), None)):
            which = np.flatnonzero(some)
            if not len(which):
                continue
            group = [pieces[i] for i in which]
            if between is None:
                ids, counts = self._coded([p.decode() for p in group])
            else:
                ids, counts = self._joined(group, between)
            first_number = len(self.known)
            self.known.update(zip(group, range(first_number, first_number + len(group))))
            numbers[which] = np.arange(first_number, first_number + len(group))
            self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(counts) - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.ids = np.concatenate([self.ids, ids])
        self.met = np.concatenate([self.met, np.zeros(len(pieces), np.int64)])
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        if not self.by_piece:
            return self._coded(texts.to_pylist())
        data, edges = _bytes_of(texts.cast(pa.large_string()))
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        if len(self.known) > KNOWN_PIECES:
            self._forget()
        starts = _piece_starts(data, edges[:-1])
        bounds = pa.py_buffer(np.append(starts, len(data)))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, bounds, pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        held, at = _bytes_of(coded.dictionary)
        held, at = held.tobytes(), at.tolist()
        different = [held[a:b] for a, b in zip(at, at[1:])]
        numbers = np.fromiter(map(self.known.get, different, repeat(-1)), np.int64, len(different))
        new = np.flatnonzero(numbers < 0)
        if len(new):
            numbers[new] = self._learn([different[i] for i in new])
        self.met[numbers] += 1
        numbers = numbers[coded.indices.to_numpy()]
        counts = self.counts.take(numbers)
        ends = np.concatenate([[0], np.cumsum(counts)])
        shift = np.repeat(self.starts.take(numbers) - ends[:-1], counts)
        ids = self.ids.take(shift + np.arange(ends[-1]))
        return ids, np.diff(ends[np.searchsorted(starts, edges)])

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of every text."""
        if not texts:
            return []
        ids, counts = self.encode(pa.array(texts, pa.string()))
        return [some.tobytes() for some in np.split(ids.astype("<i4"), np.cumsum(counts)[:-1])]


@lru_cache(maxsize=1)
def _encoder(path: str, by_piece: bool) -> _Encoder:
    """A worker's tokenizer, with the pieces that its tasks have met, if it goes by pieces."""
    return _Encoder(path, by_piece)


def _slices(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, pa.Array]]:
    """Ids and texts in groups of about ``size`` bytes, a longer text alone."""
    for batch in batches:
        names, texts = batch.column(0), batch.column(1)
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(names):
            held = int(ends[at - 1]) if at else 0
            to = max(int(np.searchsorted(ends, held + size, "right")), at + 1)
            yield names[at:to].to_pylist(), texts[at:to]
            at = to


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int,
    file_ids: int = FILE_IDS,
    doc_id: str = "doc_id",
    text: str = "text",
    by_piece: bool = False,
) -> None:
    """Write the ids of all documents, each followed by ``end_id``, in ascending order of their id.

    ``tokenizer`` is the path of a vocabulary file that every executor has. It takes every text whole;
    ``by_piece`` leaves out the pieces of texts that a worker has met.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")
    ).withColumn("_tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "_tie").sortWithinPartitions("doc_id", "_tie", "text")

    def images(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer, by_piece)
        size = TEXT_BYTES if encoder.by_piece else WHOLE_BYTES
        vocabulary = max(encoder.tokenizer.get_vocab_size(), end_id + 1)
        part = TaskContext.get().partitionId()
        names, counts, pieces = [], [], []
        number = before = held = 0

        def close() -> pa.RecordBatch:
            ids = np.concatenate(pieces)
            image = pack(names, counts, ids, vocabulary)
            columns = [[part], [number], [before], [len(ids)]]
            arrays = [pa.array(c, pa.int64()) for c in columns] + [pa.array([image], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, ["part", "number", "before", "n_ids", "image"])

        for some_names, texts in _slices(batches, size):
            ids, n_ids = encoder.encode(texts)
            ids = np.insert(ids, np.cumsum(n_ids), end_id)
            ends = np.concatenate([[0], np.cumsum(n_ids + 1)])
            at = 0
            while at < len(some_names):
                full = int(np.searchsorted(ends, ends[at] + file_ids - held))  # the text that fills the image
                to = min(max(full, at + 1), len(some_names))
                names += some_names[at:to]
                counts += np.diff(ends[at : to + 1]).tolist()
                pieces.append(ids[ends[at] : ends[to]])
                held += int(ends[to] - ends[at])
                at = to
                if held >= file_ids:
                    yield close()
                    number, before = number + 1, before + held
                    names, counts, pieces, held = [], [], [], 0
        if names:
            yield close()

    coded = dealt.select("doc_id", "text").mapInArrow(images, _IMAGES)
    plain = {"compression": "uncompressed", "parquet.enable.dictionary": "false"}
    coded.write.options(**plain).mode("overwrite").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Every document of a folder as (doc_id, start, n_tokens, ids).

    ``start`` counts the ids of all documents before it; ``ids`` are little-endian unsigned 32-bit
    integers. A damaged image stops the read.
    """
    images = spark.read.schema(_IMAGES).parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "part", "within", "n_tokens", "ids"]
        for batch in batches:
            for part, before, image in zip(*(batch.column(i) for i in range(3)), strict=True):
                known, counts, ids = unpack(image.as_py())
                edges = np.concatenate([[0], np.cumsum(counts)])
                plain = ids.astype("<u4").tobytes()
                arrays = [
                    pa.array(known, pa.int64()),
                    pa.array(np.full(len(known), part.as_py()), pa.int64()),
                    pa.array(edges[:-1] + before.as_py(), pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array([plain[4 * a : 4 * b] for a, b in zip(edges, edges[1:])], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names)

    # one row per task of the write: the only step on one task
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = images.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")
    )
    rows = images.select("part", "before", "image").mapInArrow(documents, _ROWS)
    return rows.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("within") + F.col("offset")).alias("start"), "n_tokens", "ids"
    )
