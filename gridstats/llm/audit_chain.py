"""Edit histories of a dynamic program as linked nodes that share their beginnings.

A node is one more label at the end of its parent's history. With each node go its ancestors at
distances 1, 2, 4, ... and a rolling hash of its labels, so two histories of one length are compared
by a binary search for the longest common beginning: where the hashes of two ancestors differ the
histories differ, and where they agree the ancestors are compared label by label up to the node they
share, because a hash may collide. Then the first labels that differ decide.
"""

from __future__ import annotations

import zlib

ROOT = 0
_PRIME = (1 << 61) - 1
_BASE = 1_000_003


class Histories:
    """All histories of one program; the empty one is ``ROOT``."""

    def __init__(self, hash_of=lambda label: zlib.crc32(label.encode())):
        self.hash_of = hash_of
        self.labels = [""]
        self.hashes = [1]
        self.above: list[tuple[int, ...]] = [()]

    def add(self, parent: int, label: str) -> int:
        above, ups = self.above, [parent]
        while len(above[ups[-1]]) >= len(ups):
            ups.append(above[ups[-1]][len(ups) - 1])
        above.append(tuple(ups))
        self.labels.append(label)
        self.hashes.append((self.hashes[parent] * _BASE + self.hash_of(label) + 1) % _PRIME)
        return len(self.labels) - 1

    def equal(self, a: int, b: int) -> bool:
        """Whether two histories of one length agree; agreeing hashes are verified."""
        if self.hashes[a] != self.hashes[b]:
            return False
        while a != b:
            if self.labels[a] != self.labels[b]:
                return False
            a, b = self.above[a][0], self.above[b][0]
        return True

    def before(self, a: int, b: int) -> bool:
        """Whether the first history of two, of one length, comes before the second.

        No label may be the beginning of another that can stand in its place.
        """
        if self.equal(a, b):
            return False
        for k in reversed(range(len(self.above[a]))):
            if k < len(self.above[a]) and not self.equal(self.above[a][k], self.above[b][k]):
                a, b = self.above[a][k], self.above[b][k]
        return self.labels[a] < self.labels[b]

    def text(self, node: int) -> str:
        parts = []
        while node != ROOT:
            parts.append(self.labels[node])
            node = self.above[node][0]
        return "".join(reversed(parts))
