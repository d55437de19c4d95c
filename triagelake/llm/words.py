"""Words and their hashes over many texts at once, with numpy: no Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

U64 = np.uint64
_STEP = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix)."""
    x = x + _STEP
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE = mix(np.arange(1, 257, dtype=U64))
# Odd bases, one for bytes and two for words.
BASES = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


@lru_cache
def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and its inverse modulo 2 ** 64, for i below n."""
    have = _TABLES.get(base)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        both = []
        for b in (base, _inverse(base)):
            table = np.full(size, b, dtype=U64)
            table[0] = 1
            both.append(np.multiply.accumulate(table))
        have = _TABLES[base] = (both[0], both[1])
    return have[0][:n], have[1][:n]


class Spans:
    """Hashes of any stretch of a sequence of 64-bit values in constant time each."""

    def __init__(self, values: np.ndarray, base: int) -> None:
        power, self.inverse = powers(base, max(1, len(values)))
        self.sums = np.zeros(len(values) + 1, dtype=U64)
        np.cumsum(values * power[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        start = np.asarray(start)
        return mix((self.sums[end] - self.sums[start]) * self.inverse[np.minimum(start, len(self.inverse) - 1)])


@dataclass
class Words:
    """``hashes`` of the words of some texts; those of text d are at first[d] to first[d + 1].  starts and ends are places in ``data``."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray

    def slice(self, d: int) -> slice:
        return slice(int(self.first[d]), int(self.first[d + 1]))


def words_of(texts: list[bytes]) -> Words:
    """Words and hashes of ``texts``.  Equal words have equal hashes; different ones collide with a chance of about 2 ** -64."""
    data = b" ".join(texts) + b" "
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.zeros(len(raw) + 1, dtype=np.int8)
    np.logical_not(SPACE[raw], out=inside[1:].view(bool))
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    spans = Spans(_BYTE[raw], BASES[0])
    return Words(data, starts, ends, np.searchsorted(starts, offsets), spans.of(starts, ends))


def pieces(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``most`` bytes, each with the index of its first text; a longer text makes a run of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, texts[start:]


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x, dtype=U64).view(np.int64)
