"""Encoding texts piece by piece, each distinct piece of a batch once."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np


class ChunkIds:
    """Token ids by chunk, kept between the batches of a Python worker.

    ``encode`` turns a list of distinct chunks into their ids, one chunk after
    the other, and the number of ids of each.
    The store is emptied when it would exceed ``limit`` chunks, so memory is
    bounded by that and by the chunks of one batch.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = 200_000):
        self.encode, self.limit = encode, limit
        self.index: dict[str, int] = {}
        self.starts = self.sizes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _learn(self, chunks: list[str]) -> None:
        new = set(chunks).difference(self.index)
        if new and len(self.index) + len(new) > self.limit:
            self.__init__(self.encode, self.limit)
            new = set(chunks)
        if not new:
            return
        new = list(new)
        flat, sizes = self.encode(new)
        at = len(self.flat) + np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
        self.starts, self.sizes = np.concatenate([self.starts, at]), np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, flat.astype(np.int32, copy=False)])

    def ids(self, per_text: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and each text's number of
        ids; a text is given as its chunks."""
        chunks = list(chain.from_iterable(per_text))
        if not chunks:
            return np.zeros(0, np.int32), np.zeros(len(per_text), np.int64)
        self._learn(chunks)
        at = np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))
        return self._gather(at, np.fromiter(map(len, per_text), np.int64, len(per_text)))

    def ids_of(self, distinct: list[str], which: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts given as positions in a list of distinct chunks
        and each text's number of chunks."""
        if not len(which):
            return np.zeros(0, np.int32), np.zeros(len(counts), np.int64)
        self._learn(distinct)
        return self._gather(np.fromiter(map(self.index.__getitem__, distinct), np.int64, len(distinct))[which], counts)

    def _gather(self, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        flat = self.flat[np.repeat(self.starts[at] - (ends - sizes), sizes) + np.arange(ends[-1])]
        total = np.concatenate([[0], ends])
        bounds = np.concatenate([[0], np.cumsum(counts)])
        return flat, np.diff(total[bounds])


def joined(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Id lists as one array and their sizes."""
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes


def batches_of_chars(sizes: list[int], most: int = 4_000_000):
    """(first, end) ranges of consecutive texts of at most ``most`` characters
    together (or one longer text), so that memory follows that bound."""
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > most:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)
