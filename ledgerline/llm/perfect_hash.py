"""Minimal perfect hashing of sets of 64-bit keys, with numpy.

A key is tried at one slot of each level, in turn: the keys that are alone at their slot
stay there, the others go on to the next level, which is made for those left.  A key's index
is the number of taken slots before its own, so n keys have the indexes 0 to n - 1.  The
keys themselves are kept in that order, so a lookup tells a stranger from a member.
"""

from __future__ import annotations

import numpy as np

from ledgerline.llm.words import mix

SLOTS = 2  # of a level for each key that reaches it
MOST_LEVELS = 64


def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(keys ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        """``levels``: of each level, which slots are taken."""
        self.levels = levels
        self.ranks, before = [], 0
        for taken in levels:
            self.ranks.append(np.cumsum(taken) - 1 + before)
            before += int(taken.sum())
        self.size = before

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """For distinct keys."""
        levels, rest = [], keys.astype(np.uint64)
        while len(rest):
            if len(levels) == MOST_LEVELS:
                raise ValueError("the keys are not distinct")
            size = max(64, SLOTS * len(rest))
            slots = _slots(rest, len(levels), size)
            taken = np.bincount(slots, minlength=size) == 1
            levels.append(taken)
            rest = rest[~taken[slots]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; of a stranger any index, or -1."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (taken, ranks) in enumerate(zip(self.levels, self.ranks)):
            slots = _slots(keys[left].astype(np.uint64), level, len(taken))
            here = taken[slots]
            out[left[here]] = ranks[slots[here]]
            left = left[~here]
        return out

    def verified_index(self, keys: np.ndarray, in_order: np.ndarray) -> np.ndarray:
        """The index of each key, -1 for strangers; ``in_order`` has the keys by index."""
        at = self.index(keys)
        known = at >= 0
        known[known] = in_order[at[known]] == keys[known]
        return np.where(known, at, -1)

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], "<u4")
        return sizes.tobytes() + b"".join(np.packbits(taken).tobytes() for taken in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, "<u4", 1)[0])
        sizes, at = np.frombuffer(data, "<u4", n, 4), 4 + 4 * n
        levels = []
        for size in sizes.tolist():
            length = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, length, at), count=size).astype(bool))
            at += length
        return cls(levels)
