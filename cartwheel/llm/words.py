"""Words of many texts at once, on raw UTF-8 bytes with numpy.

A word is a run of bytes other than ``\\x20`` and ``\\x09``-``\\x0D`` (the same
as a run of characters: UTF-8 never uses those bytes inside a character).
Texts are taken in chunks of a few hundred kilobytes, so memory follows the
longest single text (about 60 bytes per byte of it), never the batch.

Every word gets a 64-bit polynomial hash over random byte values, computed
for all words of a chunk from one running sum.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_rng = np.random.Generator(np.random.PCG64(20240901))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a uint64 over all its bits (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * _M1
    h = h ^ (h >> np.uint64(33))
    h = h * _M2
    return h ^ (h >> np.uint64(33))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _BASE_INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def byte_sums(data: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(running sums with a leading 0, inverse powers): the hash of bytes
    ``s:e`` is ``mix((sums[e] - sums[s]) * inverse[s])``."""
    n = 1 << max(20, int(len(data)).bit_length())
    up, down = _powers(n)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * up[: len(data)], out=sums[1:])
    return sums, down


def span_hash(sums: np.ndarray, inverse: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def to_bytes(column: pa.Array) -> list[bytes]:
    """The column's texts as UTF-8; null is empty."""
    return [x or b"" for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most ``limit`` bytes together (or one text)."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


class Words:
    """The words of some texts: byte spans, owner and count per text.

    ``data`` holds the texts with a newline after each; ``first[d]`` and
    ``first[d + 1]`` bound the words of text ``d``.  ``breaks`` marks the bytes
    between words (white space; the newline must be one of them).
    """

    def __init__(self, texts: list[bytes], breaks: np.ndarray = SPACE):
        self.texts = texts
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts))
        self.offsets = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum(lengths + 1, out=self.offsets[1:])
        space = breaks[self.data]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        if len(space) and not space[0]:
            edge = np.concatenate(([0], edge))
        # texts end in a newline, so edges alternate start, end
        self.starts, self.ends = edge[0::2], edge[1::2]
        self.first = np.searchsorted(self.starts, self.offsets)
        self.counts = np.diff(self.first)

    def hashes(self, lower: bool = True) -> np.ndarray:
        sums, inverse = byte_sums(self.data, lower)
        return span_hash(sums, inverse, self.starts, self.ends)

    def owners(self) -> np.ndarray:
        """The text index of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


_SHINGLE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def shingle_sets(words: Words, width: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its ``width``-word
    shingles over lower-cased (A-Z) words; with fewer words the whole sequence
    as one shingle; without words empty."""
    h = words.hashes()
    n = len(h)
    rolled = np.zeros(max(n - width + 1, 0), dtype=np.uint64)
    for j in range(width):
        rolled += h[j : j + len(rolled)] * _SHINGLE[j]
    rolled = mix(rolled)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= width:
            s = np.sort(rolled[a : b - width + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            out.append(mix((h[a:b] * _SHINGLE[: b - a]).sum(dtype=np.uint64, keepdims=True) + _SHINGLE[63 - (b - a)]))
        else:
            out.append(rolled[:0])
    return out
