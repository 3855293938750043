"""Burrows-Wheeler transform of a collection, built column by column with its common prefixes.

Round j inserts the suffix of length j of every string at once, one symbol for each string. The
transform, the common prefixes and the owners of the suffixes lie in files that a round reads once
and writes anew, from front to back.
"""

import os

import numpy as np

OPEN = 0xFF  # stands in the transform where the next symbol is not known yet; no UTF-8 byte
class Collection:
    """``strings`` of at least ``depth`` bytes; common prefixes are counted up to ``depth``."""

    def __init__(self, strings: list[bytes], depth: int, folder: str):
        self.depth, self.folder, self.round = depth, folder, 0
        self.sizes = np.array([len(s) for s in strings])
        self.width = int(self.sizes.max())
        columns = b"".join(s.rjust(self.width, b"\0") for s in strings)
        self.symbols = np.frombuffer(columns, np.uint8).reshape(-1, self.width)
        n, owners = len(strings), len(strings) * (self.width + 1)
        self.kinds = (np.uint8, np.uint8, np.uint32 if owners < 2**32 else np.uint64)
        # Each string starts with its empty suffix; these stand first, in the order of strings.
        self.place = np.arange(n)
        self._write(np.full(n, OPEN, np.uint8), np.zeros(n, np.uint8),
                    self._owner(np.arange(n), 0))

    def _owner(self, string, size):
        return (string * (self.width + 1) + size).astype(self.kinds[2])

    def _file(self, name: str) -> str:
        return os.path.join(self.folder, f"{name}-{self.round}")

    def _write(self, *columns) -> None:
        for name, column in zip(("transform", "prefix", "owner"), columns):
            column.tofile(self._file(name))

    def _read(self) -> list[np.ndarray]:
        out = []
        for name, kind in zip(("transform", "prefix", "owner"), self.kinds):
            out.append(np.fromfile(self._file(name), kind))
            os.remove(self._file(name))
        return out

    def insert(self) -> None:
        """Insert the next symbol of every string that has one."""
        transform, prefix, owner = self._read()
        self.round += 1
        active = np.flatnonzero(self.sizes >= self.round)
        transform[self.place[active]] = self.symbols[active, self.width - self.round]
        # Suffixes stand in the order of their first symbol, and of the place where it stands in
        # the transform: the i-th symbol in this order begins the i-th suffix.
        order = np.argsort(transform, kind="stable")
        n, m = len(transform), len(active)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        own = np.sort(rank[self.place[active]])
        new = np.zeros(n + 1, bool)
        new[own] = True
        at = order[own]
        # A suffix shares with the one before it, if that begins alike, one symbol more than their
        # tails do, and the tails share the least of what lies between them.
        before = order[own - 1]
        alike = (own > 0) & (transform[before] == transform[at])
        common = np.zeros(m, np.int64)
        common[alike] = 1 + lowest(prefix, before[alike] + 1, at[alike])
        # The same holds for an older suffix that now follows a new one.
        after = order[np.minimum(own + 1, n - 1)]
        alike = (own + 1 < n) & ~new[own + 1] & (transform[after] == transform[at])
        after_common = 1 + lowest(prefix, at[alike] + 1, after[alike])
        target = own + len(self.sizes)
        old = np.ones(n + m, bool)
        old[target] = False
        string = np.empty(n, np.int64)
        string[self.place[active]] = active
        string = string[at]
        grown = []
        for column, value in ((transform, OPEN), (prefix, np.minimum(common, self.depth)),
                              (owner, self._owner(string, self.round))):
            column_grown = np.empty(n + m, column.dtype)
            column_grown[old] = column
            column_grown[target] = value
            grown.append(column_grown)
        grown[1][target[alike] + 1] = np.minimum(after_common, self.depth)
        self.place[string] = target
        self._write(*grown)

    def build(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """In the order of suffixes: common prefix with the one before, string, start in it."""
        while self.round < self.width:
            self.insert()
        _, prefix, owner = self._read()
        string, size = np.divmod(owner.astype(np.int64), self.width + 1)
        return prefix, string, self.sizes[string] - size


def lowest(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The least of ``values[first..last]`` for each pair, both ends included."""
    if not len(first):
        return np.zeros(0, np.int64)
    size = last - first + 1
    start = np.cumsum(size) - size
    at = np.arange(size.sum()) + np.repeat(first - start, size)
    return np.minimum.reduceat(values[at], start).astype(np.int64)
