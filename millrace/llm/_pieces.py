"""Encoding many texts through a tokenizer by their distinct chunks.

A text cut at places no token can cross has the ids of its chunks, in order.
Words repeat, so each distinct chunk goes to the tokenizer library once (in one
multithreaded ``encode_batch`` per batch of texts) and texts are put together
from the stored ids by one numpy gather. The store is emptied when it reaches
``most`` chunks, so a worker's memory stays bounded; long chunks are not kept.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable
from itertools import chain, repeat

import numpy as np

LONG_CHUNK = 64


class ChunkStore:
    """``encode``: distinct chunks -> the ids of each as packed 32-bit integers."""

    def __init__(self, encode: Callable[[list], list[bytes]], most: int = 600_000):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.row: dict[Hashable, int] = {}
        self.start = np.zeros(1024, np.int64)
        self.size = np.zeros(1024, np.int64)
        self.flat = np.zeros(8192, np.int32)
        self.rows = self.used = 0

    def _grown(self, a: np.ndarray, least: int) -> np.ndarray:
        if least <= len(a):
            return a
        b = np.zeros(max(least, 2 * len(a)), a.dtype)
        b[:len(a)] = a
        return b

    def _add(self, chunks: list) -> None:
        ids = self.encode(chunks)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        end, total = self.rows + len(ids), int(sizes.sum())
        self.start, self.size = self._grown(self.start, end), self._grown(self.size, end)
        self.flat = self._grown(self.flat, self.used + total)
        self.size[self.rows:end] = sizes
        self.start[self.rows:end] = self.used + np.cumsum(sizes) - sizes
        self.flat[self.used:self.used + total] = np.frombuffer(b"".join(ids), np.int32)
        self.row.update(zip(chunks, range(self.rows, end)))
        self.rows, self.used = end, self.used + total

    def _rows(self, chunks: list) -> tuple[np.ndarray, list]:
        """Row of each chunk, and the chunks that had to be added."""
        rows = np.fromiter(map(self.row.get, chunks, repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(rows < 0).tolist()
        new = list({chunks[i] for i in missing})
        if missing:
            self._add(new)
            rows[missing] = [self.row[chunks[i]] for i in missing]
        return rows, new

    def _gathered(self, rows: np.ndarray, counts, new: list) -> list[np.ndarray]:
        size = self.size[rows]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        out = self.flat[np.arange(total) + np.repeat(self.start[rows] - (ends - size), size)]
        upto = np.concatenate([[0], ends])[np.cumsum([0, *counts])]
        for c in new:
            if len(c) > LONG_CHUNK:
                del self.row[c]             # its ids stay in the arrays until the next clear
        if new and (self.rows > self.most or self.used > 8 * self.most):
            self.clear()
        return [out[a:b] for a, b in zip(upto, upto[1:])]

    def texts(self, texts: list[list]) -> list[np.ndarray]:
        """Ids of each text, given as its list of chunks."""
        rows, new = self._rows(list(chain.from_iterable(texts)))
        return self._gathered(rows, map(len, texts), new)

    def coded(self, distinct: list, codes: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
        """Ids of each text, given as ``counts`` numbers of ``distinct`` chunks."""
        rows, new = self._rows(distinct)
        return self._gathered(rows[codes], counts.tolist(), new)


def in_groups(n_items: int, weight: Callable[[int], int], most: int = 1 << 21):
    """Slices of 0..n_items whose weights stay under ``most`` (one item at least)."""
    a, total = 0, 0
    for i in range(n_items):
        w = weight(i)
        if i > a and total + w > most:
            yield a, i
            a, total = i, 0
        total += w
    if a < n_items:
        yield a, n_items
