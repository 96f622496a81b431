"""Hashed words of texts, worked out for many texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from turnmill.llm.common import worker_store

#: Bytes of text that are hashed in one go (a longer text goes alone).
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    return h ^ (h >> np.uint64(31))


def slices(bodies: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of up to ``SLICE_BYTES`` together, with the place of the first."""
    start, size = 0, 0
    for i, body in enumerate(bodies):
        if i > start and size + len(body) > SLICE_BYTES:
            yield start, bodies[start:i]
            start, size = i, 0
        size += len(body)
    if start < len(bodies):
        yield start, bodies[start:]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    store = worker_store("powers")
    if len(store.get("up", ())) < n:
        size = max(n, 2 * SLICE_BYTES)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            run = np.full(size, base, dtype=np.uint64)
            run[0] = 1
            store[name] = np.cumprod(run)
    return store["up"], store["down"]


class Spans:
    """The runs of bytes of given kinds in some texts; none crosses the edge of a text."""

    def __init__(self, bodies: list[bytes], inside: np.ndarray):
        self.blob = np.frombuffer(b"".join(bodies), dtype=np.uint8)
        n = len(self.blob)
        ends = np.cumsum([len(b) for b in bodies])
        flags = inside[self.blob]
        opens, closes = flags.copy(), flags.copy()
        opens[1:] &= ~flags[:-1]
        closes[:-1] &= ~flags[1:]
        edges = ends[ends < n]
        opens[edges] = flags[edges]
        closes[edges[edges > 0] - 1] = flags[edges[edges > 0] - 1]
        self.starts = np.flatnonzero(opens)
        self.ends = np.flatnonzero(closes) + 1
        self.doc = np.searchsorted(ends, self.starts, side="right")
        up, self._down = _powers(n + 1)
        self._sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((self.blob.astype(np.uint64) + np.uint64(1)) * up[:n], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of each span, alike wherever they stand."""
        return mix((self._sums[ends] - self._sums[starts]) * self._down[starts])


def kinds(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 flags."""
    out = np.zeros(256, dtype=bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


VISIBLE = kinds((0x21, 0xFF))
LETTERS = kinds((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
