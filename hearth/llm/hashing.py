"""Word hashes of many texts at once, without a Python step per word.

A word's hash is the polynomial ``sum(T[b_j] * P^j) mod 2^64`` over its bytes,
taken from one running sum over the whole buffer and moved to the word's start by
the inverse power, then mixed. ``T`` is a fixed table of random numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

SLAB = 1 << 18      # bytes hashed at a time
_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Full avalanche of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Slab:
    """Words of some texts in a row: word i of text d is number ``offsets[d] + i``
    and stands at ``buffer[starts[n]:ends[n]]`` (folded bytes)."""

    hashes: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    buffer: bytes

    def word(self, n: int) -> bytes:
        return self.buffer[self.starts[n]:self.ends[n]]


class WordHasher:
    """``fold``: table of 256 bytes applied first; it must map every separator to a
    space and nothing else. Words are maximal runs of one class of ``classes``
    (class of each folded byte, the space's is 0)."""

    def __init__(self, fold: bytes, classes: bytes | None = None):
        self.fold = fold
        self.classes = np.frombuffer(classes, np.uint8) if classes else (np.arange(256) != 32).astype(np.uint8)
        self.table = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            for name, base in (("power", _P), ("inverse", _INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def _words(self, buffer: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = np.frombuffer(buffer, np.uint8)
        self._powers(len(codes) + 1)
        kind = np.zeros(len(codes) + 2, np.uint8)
        kind[1:-1] = self.classes[codes]
        turn = np.flatnonzero(kind[1:] != kind[:-1])
        starts = turn[kind[turn + 1] > 0]
        ends = turn[kind[turn] > 0]
        running = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(self.table[codes] * self.power[:len(codes)], out=running[1:])
        return mixed((running[ends] - running[starts]) * self.inverse[starts]), starts, ends

    def _long(self, text: bytes) -> Slab:
        """One text of any length, a piece at a time."""
        parts, at = [], 0
        while at < len(text):
            end = len(text)
            if end - at > SLAB:
                end = text.rfind(b" ", at, at + SLAB)
                end = text.find(b" ", at + SLAB) if end < 0 else end
                end = len(text) if end < 0 else end
            h, s, e = self._words(text[at:end])
            parts.append((h, s + at, e + at))
            at = end + 1
        h, s, e = (np.concatenate(x) for x in zip(*parts))
        return Slab(h, np.array([0, len(h)]), s, e, text)

    def slabs(self, texts: list[bytes | None]) -> Iterator[Slab]:
        """The texts in order, some at a time (null: no words)."""
        held, size = [], 0
        for text in texts:
            folded = text.translate(self.fold) if text else b""
            if size and size + len(folded) > SLAB:
                yield self._slab(held)
                held, size = [], 0
            if len(folded) > SLAB:
                if held:
                    yield self._slab(held)
                    held = []
                yield self._long(folded)
                continue
            held.append(folded)
            size += len(folded) + 1
        if held:
            yield self._slab(held)

    def _slab(self, texts: list[bytes]) -> Slab:
        buffer = b" ".join(texts)
        h, s, e = self._words(buffer)
        first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        return Slab(h, np.searchsorted(s, first), s, e, buffer)


def rolled(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k words in a row (``len(h) - k + 1`` of them)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = out * np.uint64(_P) + h[i:n + i]
    return mixed(out).view(np.int64)
