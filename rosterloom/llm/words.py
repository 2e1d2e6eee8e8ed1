"""Words of many texts at once, as 64-bit hashes in numpy arrays.

Texts are laid side by side as bytes; word borders, hashes and lookups are array
operations, so no string is made for a word. A hash is the sum over a word's bytes
of a random number for the byte times one for its place, mixed.
"""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.default_rng(64)
_OF_BYTE = _RANDOM.integers(1 << 62, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OF_PLACE = _RANDOM.integers(1 << 62, 1 << 63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes that are hashed at a time.
_PART = 1 << 18


def side_by_side(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes, a blank before each text and at the end, and the place of each
    text's first byte (and of the end)."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    return data, np.cumsum([1, *(len(t) + 1 for t in texts)])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, of_byte: np.ndarray = _OF_BYTE) -> np.ndarray:
    """Of the runs of bytes from ``starts`` to ``ends``; at least one byte each."""
    out = np.zeros(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + _PART, "right")))
        sizes = ends[a:b] - starts[a:b]
        first = np.cumsum(sizes) - sizes
        place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
        own = of_byte[data[place + np.repeat(starts[a:b], sizes)]]
        own *= _OF_PLACE[place & 1023]
        if int(sizes.max()) > 1024:
            # the places' numbers come again, times another odd one
            own *= (2 * (place >> 10) + 1).astype(np.uint64)
        out[a:b] = np.add.reduceat(own, first)
        a = b
    return mixed(out)


def borders(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs between blanks (space, tab to carriage return)."""
    blank = _BLANK[data]
    edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    return edges[::2], edges[1::2]


def words_of(texts: list[bytes], of_byte: np.ndarray = _OF_BYTE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, in order, and the number of words before
    each text (and in all)."""
    data, bounds = side_by_side(texts)
    starts, ends = borders(data)
    return hashes(data, starts, ends, of_byte), np.searchsorted(starts, bounds)


#: For words in which A-Z count as a-z.
CASELESS = _OF_BYTE[_LOWER]


class Table:
    """A map from hashes (not 0) to numbers from 0 on, by open addressing."""

    def __init__(self, bits: int = 16):
        self.bits, self.keys, self.values = bits, np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.int32)
        self.size = 0

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of the keys, -1 for those that aren't there."""
        at, mask = self._slots(keys), len(self.keys) - 1
        met = self.keys[at]
        out = np.where(met == keys, self.values[at], np.int32(-1))
        left = np.flatnonzero((met != keys) & (met != 0))
        while len(left):
            at[left] = (at[left] + 1) & mask
            met, own = self.keys[at[left]], keys[left]
            hit = met == own
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (met != 0)]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that aren't there yet."""
        self.size += len(keys)
        if 2 * self.size > len(self.keys):
            old, known = self.keys != 0, (self.keys, self.values)
            bits = max(self.bits + 1, (2 * self.size).bit_length())
            self.__init__(bits)
            self.size = int(old.sum()) + len(keys)
            self._put(known[0][old], known[1][old])
        self._put(keys, values)

    def _put(self, keys: np.ndarray, values: np.ndarray) -> None:
        at, mask = self._slots(keys), len(self.keys) - 1
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] == 0]
            slots, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.keys[slots], self.values[slots] = keys[put], values[put]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = (at[left] + 1) & mask
