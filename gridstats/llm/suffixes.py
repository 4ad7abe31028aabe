"""Grouping suffix order of many short pieces at once.

The order of all suffixes is built from Lyndon prefixes in two phases, without renaming the text
recursively:

1. From the right end of every piece each suffix finds the next smaller suffix; the stretch up to
   it is the suffix's Lyndon prefix. Pieces advance in lockstep, a column at a time, along the
   pointers already set, so every pointer is passed a bounded number of times.
2. Suffixes with one Lyndon prefix form a group. Groups are laid out from the highest prefix down;
   within a group the order is that of the suffixes their pointers lead to, so a group's order is
   emitted from ranks that exist already, one pointer further in each pass, for open ties only.

Pieces are independent strings: the end of a piece is smaller than any byte.
"""

from __future__ import annotations

import numpy as np

_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
_KEEP = np.array([0] + [(_FULL << np.uint64(8 * (8 - i))) & _FULL for i in range(1, 9)], np.uint64)


class Pieces:
    """Byte strings as rows of a matrix, padded with zeros, with eight bytes from each place."""

    def __init__(self, texts: list[bytes]):
        self.length = np.array([len(t) for t in texts], np.int64)
        self.width = int(self.length.max()) if len(texts) else 0
        wide = self.width + 72
        padded = b"".join(t.ljust(wide, b"\0") for t in texts)
        # big-endian words, so numbers compare as the bytes do
        words = np.ndarray((len(padded) - 7,), np.dtype(">u8"), buffer=padded, strides=(1,))
        self.wide = wide
        self.word = words.astype(np.uint64)

    def at(self, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        return row * self.wide + column


def _less(p: Pieces, u: np.ndarray, nu: np.ndarray, v: np.ndarray, nv: np.ndarray) -> np.ndarray:
    """Whether the strings at places ``u`` of lengths ``nu`` are smaller than those at ``v``."""
    a, b = p.word[u] & _KEEP[np.minimum(nu, 8)], p.word[v] & _KEEP[np.minimum(nv, 8)]
    out = (a < b) | ((a == b) & (nu < nv))
    deeper = np.nonzero((a == b) & (nu > 8) & (nv > 8))[0]
    if len(deeper):
        out[deeper] = _less(p, u[deeper] + 8, nu[deeper] - 8, v[deeper] + 8, nv[deeper] - 8)
    return out


def smaller_next(p: Pieces) -> np.ndarray:
    """(row, column): the column of the next smaller suffix, or the piece's length."""
    rows = len(p.length)
    pointer = np.zeros((rows, p.width + 1), np.int64)
    for c in range(p.width - 1, -1, -1):
        open_ = np.nonzero(p.length > c)[0]
        end = np.full(rows, c + 1, np.int64)
        while len(open_):
            open_ = open_[end[open_] < p.length[open_]]
            j = end[open_]
            after = pointer[open_, j]
            longer = _less(p, p.at(open_, np.int64(c)), j - c, p.at(open_, j), after - j)
            open_, after = open_[longer], after[longer]
            end[open_] = after
        pointer[:, c] = end
    return pointer


def _runs(change: np.ndarray) -> np.ndarray:
    """For sorted entries: the first place of each run of equal ones; ``change`` marks run starts."""
    return np.maximum.accumulate(np.where(change, np.arange(len(change)), 0))


def _changes(values: np.ndarray) -> np.ndarray:
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def _tied(change: np.ndarray) -> np.ndarray:
    """Whether each entry has its run in common with another."""
    last = np.append(change[1:], True)
    return ~(change & last)


def _split(rank: np.ndarray, which: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order ``which`` by rank and key and give each (rank, key) the rank of its first place.

    Returns ``which`` in that order. ``rank`` holds the first place of a class, so a class that is
    split keeps its places among the others.
    """
    order = np.argsort((rank[which].astype(np.uint64) << np.uint64(32)) | key.astype(np.uint64))
    which, key = which[order], key[order]
    own = rank[which]
    classes = _changes(own)
    rank[which] = own + _runs(classes | _changes(key)) - _runs(classes)
    return which


def _group(p: Pieces, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rank of the group of each Lyndon prefix: the first place of its group in the order.

    Prefixes are compared seven bytes at a time; the eighth byte of a key says how many were left.
    """
    rank = np.zeros(len(place), np.int64)
    which, depth = np.arange(len(place)), 0
    while len(which):
        left = size[which] - depth
        key = (p.word[place[which] + depth] & _KEEP[np.clip(left, 0, 7)]) & ~np.uint64(0xFF)
        key |= np.clip(left, 0, 8).astype(np.uint64)
        order = np.argsort(key)
        sorted_key = key[order]
        if depth == 0:
            which = which[order]
            rank[which] = _runs(_changes(sorted_key))
        else:  # keys of this depth as small numbers, then by rank and key
            number = np.empty(len(key), np.int64)
            number[order] = np.cumsum(_changes(sorted_key))
            which = _split(rank, which, number)
        more = _tied(_changes(rank[which])) & (size[which] - depth > 7)
        which = which[more]
        depth += 7
    return rank


def suffix_order(p: Pieces, reach: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, rank) of suffixes in order; equal ones share the rank.

    With ``reach`` only suffixes of at least so many bytes are ordered, and only by so many: what
    agrees in them may share a rank or not, but stands together.
    """
    pointer = smaller_next(p)
    row, column = np.nonzero(np.arange(p.width)[None, :] < p.length[:, None])
    group = np.zeros((len(p.length), p.width + 1), np.int64)  # 0 is the end of a piece
    group[row, column] = _group(p, p.at(row, column), pointer[row, column] - column) + 1
    whole = column + (reach or 0) <= p.length[row]
    row, column = row[whole], column[whole]
    last = column + reach - 1 if reach else p.length[row]
    first = group[row, column]
    # inside a group the order is that of the groups the pointers lead through
    which = np.argsort(first, kind="stable")
    rank = np.empty(len(row), np.int64)
    rank[which] = _runs(_changes(first[which]))
    at = pointer[row, column]
    which = which[_tied(_changes(rank[which])) & (at[which] <= last[which])]
    while len(which):
        which = _split(rank, which, group[row[which], at[which]])
        which = which[_tied(_changes(rank[which]))]
        which = which[at[which] < p.length[row[which]]]
        at[which] = pointer[row[which], at[which]]
        which = which[at[which] <= last[which]]
    order = np.argsort(rank, kind="stable")
    return row[order], column[order], rank[order]


def equal_windows(p: Pieces, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, class) of every window of ``size`` bytes; equal windows share their class."""
    row, column, _ = suffix_order(p, size)
    place = p.at(row, column)
    same = np.ones(max(0, len(row) - 1), bool)
    for depth in range(0, size, 8):
        part = p.word[place + depth] & _KEEP[min(8, size - depth)]
        same &= part[1:] == part[:-1]
    return row, column, np.concatenate([[0], np.cumsum(~same)])[: len(row)]
