"""A bounded memo of encoded words, kept by each Python worker."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator


class WordMemo:
    """word -> encoded bytes.  Unknown words of a text are encoded together; when more than
    ``limit`` words are held the memo starts again, so its memory is bounded and the result
    never depends on it."""

    def __init__(self, encode_many: Callable[[list], Iterable[bytes]], limit: int):
        self.encode_many = encode_many  # may look up and add parts of words in ``known``
        self.limit = limit
        self.known: dict = {}  # a plain dict: set.difference looks into no other kind

    def encode(self, words: list) -> bytes:
        new = list(set(words).difference(self.known))
        if len(self.known) + len(new) > self.limit:
            self.known = {}
            new = list(set(words))
        if new:
            self.known.update(zip(new, self.encode_many(new)))
        return b"".join(map(self.known.__getitem__, words))


class Seen(dict):
    """word -> encoded bytes, a dictionary that encodes a word when it is first asked for, so a
    text of known words takes one look-up each.  Of two halves, the newer fills up while
    the older is only read; a word found there moves over, so frequent words stay.  Both
    hold ``limit`` words at most."""

    def __init__(self, encode_one: Callable[[bytes], bytes], limit: int):
        self.encode_one, self.half, self.older = encode_one, max(1, limit // 2), {}

    def __missing__(self, word: bytes) -> bytes:
        found = self.older.get(word)
        if found is None:
            found = self.encode_one(word)
        if len(self) >= self.half:
            self.older = self.copy()
            self.clear()
        self[word] = found
        return found

    def encode(self, words: list) -> bytes:
        return b"".join(map(self.__getitem__, words))


def slices(items: list, size: int) -> Iterator[list]:
    for i in range(0, len(items), size):
        yield items[i : i + size]
