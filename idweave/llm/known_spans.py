"""What a worker remembers of spans of text, by their 64-bit hash."""

from __future__ import annotations

import numpy as np


class KnownSpans:
    """Numbers distinct hashes from 0 on in the order they are added.

    Open addressing in two arrays, looked up for a whole array of hashes at once.
    """

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.count = 0
        self._keys = np.zeros(1 << 16, np.uint64)
        self._number = np.zeros(1 << 16, np.int32)

    @staticmethod
    def _as_keys(h: np.ndarray) -> np.ndarray:
        return np.where(h == 0, np.uint64(1), h)  # 0 marks a free slot

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for those not added."""
        h = self._as_keys(h)
        mask = np.uint64(len(self._keys) - 1)
        out = np.full(len(h), -1, np.int64)
        todo = np.arange(len(h))
        slot = h & mask
        while len(todo):
            key, want = self._keys[slot], h[todo]
            hit = key == want
            out[todo[hit]] = self._number[slot[hit]]
            on = ~hit & (key != 0)
            todo, slot = todo[on], (slot[on] + np.uint64(1)) & mask
        return out

    def add(self, h: np.ndarray) -> None:
        """Number distinct hashes that :meth:`find` doesn't know."""
        size = len(self._keys)
        if 2 * (self.count + len(h)) > size:
            while 2 * (self.count + len(h)) > size:
                size *= 2
            old, number = self._keys, self._number
            self._keys, self._number = np.zeros(size, np.uint64), np.zeros(size, np.int32)
            used = old != 0
            self._put(old[used], number[used])
        self._put(self._as_keys(h), np.arange(self.count, self.count + len(h)))
        self.count += len(h)

    def _put(self, h: np.ndarray, number: np.ndarray) -> None:
        mask = np.uint64(len(self._keys) - 1)
        slot = h & mask
        while len(h):
            free = self._keys[slot] == 0
            self._keys[slot[free]] = h[free]  # of those that want one slot the last stays
            own = free & (self._keys[slot] == h)
            self._number[slot[own]] = number[own]
            h, number, slot = h[~own], number[~own], (slot[~own] + np.uint64(1)) & mask
