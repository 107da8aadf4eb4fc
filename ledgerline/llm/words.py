"""Word hashes of whole batches of texts with numpy: no Python step per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20  # bytes hashed at a time; the arrays of powers are this long
GROUP = 1 << 20  # bytes of text taken together

_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
#: Words are runs of anything but ASCII white space.
NOT_SPACE = ~_SPACE
#: Words are runs of ASCII letters, digits and all characters from U+0080 on.
ALNUM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_random = np.random.default_rng(20240607)
_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base modulo 2**64, and their inverses."""
    if not _powers or len(_powers[0]) < n:
        factors = np.full((2, max(n, PIECE)), _BASE)
        factors[1] = pow(int(_BASE), -1, 1 << 64)
        factors[:, 0] = 1
        _powers[:] = np.cumprod(factors, axis=1, dtype=np.uint64)
    return _powers


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit number over all bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def hash_words(text: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, start and end of each word of the bytes of a lower-cased text."""
    found = []
    at = 0
    while at < len(text):
        stop = min(len(text), at + PIECE)
        while stop < len(text) and is_word[text[stop]]:  # not within a word
            stop += 1
        part = text[at:stop]
        edges = np.flatnonzero(np.diff(is_word[part], prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        power, inverse = _power_tables(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_VALUE[part] * power[: len(part)], out=sums[1:])
        found.append((mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), starts + at, ends + at))
        at = stop
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


@dataclass
class Words:
    """The words of a group of documents: those of document i are first[i]:first[i + 1]."""

    lower: np.ndarray  # the texts, lower-cased, with a line end after each
    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    at: np.ndarray  # where each text begins


def words_of(texts: pa.Array, is_word: np.ndarray) -> Iterator[tuple[int, Words]]:
    """Groups of the texts of a column, in order: number of texts and their words.  Null
    texts have no words.  A-Z are lower-cased."""
    buffers = [t.as_buffer() if t.is_valid else b"" for t in texts.cast(pa.large_binary())]
    lo = 0
    while lo < len(buffers):
        hi, size = lo, 0
        while hi < len(buffers) and (hi == lo or size + len(buffers[hi]) <= GROUP):
            size += len(buffers[hi])
            hi += 1
        lengths = np.array([len(b) + 1 for b in buffers[lo:hi]])
        at = np.concatenate([[0], np.cumsum(lengths)])
        lower = _LOWER[np.frombuffer(b"\n".join([*buffers[lo:hi], b""]), np.uint8)]
        hashes, starts, ends = hash_words(lower, is_word)
        yield hi - lo, Words(lower, hashes, starts, ends, np.searchsorted(starts, at), at)
        lo = hi
