"""A minimal perfect hash over 64-bit keys, in numpy.

Levels of bit arrays: a key that is alone at its place on a level stays there, the others go on
to the next, smaller level. A key's index is the number of set bits before its own, so n keys
get the indexes 0 to n-1 for about four bits each. Keys that still collide on the last level
are listed. The same key always gives the same index; a foreign key gives an arbitrary index or
-1, hence the fingerprints kept beside the counts.
"""

from __future__ import annotations

import numpy as np

ROOM = 2.0  # places per key on a level
LEVELS = 40


def mix(keys: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finaliser (fixed public constants) of keys, different for each salt."""
    x = keys.astype(np.uint64) + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys, level) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """sizes: places of each level; bits: all levels' bits; rest: keys that found no place."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        set_bits = np.unpackbits(bits, count=int(self.starts[-1]))
        self.taken = set_bits.astype(bool)
        self.rank = np.concatenate([[0], np.cumsum(set_bits, dtype=np.int64)])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys``: distinct 64-bit keys."""
        left, sizes, levels = np.asarray(keys).view(np.uint64), [], []
        while len(left) and len(sizes) < LEVELS:
            size = max(8, int(len(left) * ROOM))
            at = place(left, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        bits = np.packbits(np.concatenate(levels) if levels else np.zeros(0, bool))
        return cls(np.array(sizes, np.int64), bits, np.sort(left))

    def index(self, keys: np.ndarray) -> np.ndarray:
        keys = np.asarray(keys).view(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                return out
            at = self.starts[level] + place(keys[open_], level, int(size))
            hit = self.taken[at]
            out[open_[hit]] = self.rank[at[hit]]
            open_ = open_[~hit]
        if len(self.rest) and len(open_):
            at = np.minimum(np.searchsorted(self.rest, keys[open_]), len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            out[open_[hit]] = self.rank[-1] + at[hit]
        return out

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), len(self.rest)], np.int64)
        return b"".join(x.tobytes() for x in (head, self.sizes, self.rest, self.bits))

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        levels, rest = np.frombuffer(data, np.int64, 2)
        sizes = np.frombuffer(data, np.int64, levels, 16)
        left = np.frombuffer(data, np.uint64, rest, 16 + 8 * levels)
        return cls(sizes, np.frombuffer(data, np.uint8, offset=16 + 8 * (levels + rest)), left)
