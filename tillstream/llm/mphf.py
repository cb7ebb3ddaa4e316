"""Minimal perfect hashing of distinct whole numbers, built and asked in numpy.

A key sets the bit at its hashed place of the first level where no other key has the same place;
the others go on to the next, smaller level. The number of set bits before its own is the key's index, so n keys have
the indices 0 to n - 1 at about four bits each. A key that was not there when the hash was built gets some index or
none: whoever asks compares the key stored at the index.
"""

from __future__ import annotations

import numpy as np

_MOST_LEVELS = 64
_WORD = np.uint64(63)


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    """A hash of 64 bits; every level has its own."""
    with np.errstate(over="ignore"):
        x = keys.astype(np.uint64) + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """``sizes`` of the levels in bits, and the bits of all levels in a row."""

    def __init__(self, sizes: list[int], words: np.ndarray) -> None:
        self.sizes, self.words = sizes, words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(words), dtype=np.int64)))

    def __len__(self) -> int:
        return int(self.before[-1])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` must be distinct."""
        sizes, bits, left = [], [np.zeros(0, np.uint8)], np.asarray(keys)
        while len(left):
            if len(sizes) == _MOST_LEVELS:
                raise ValueError("keys are not distinct")
            size = -(-2 * len(left) // 64) * 64
            at = (_mix(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            bits.append(np.packbits(alone, bitorder="little"))
            sizes.append(size)
            left = left[~alone[at]]
        return cls(sizes, np.concatenate(bits).view(np.uint64))

    def to_bytes(self) -> bytes:
        return np.array([len(self.sizes), *self.sizes], np.uint64).tobytes() + self.words.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        words = np.frombuffer(data, np.uint64)
        n = int(words[0])
        return cls(words[1 : n + 1].astype(np.int64).tolist(), words[n + 1 :])

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, -1 where no level has its bit."""
        out = np.full(len(keys), -1, np.int64)
        left, begin = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            if not len(left):
                break
            at = (_mix(keys[left], level) % np.uint64(size)) + np.uint64(begin)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & _WORD
            own = self.words[word]
            hit = (own >> bit) & np.uint64(1) == 1
            lower = own & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (self.before[word] + np.bitwise_count(lower))[hit]
            left, begin = left[~hit], begin + size
        return out
