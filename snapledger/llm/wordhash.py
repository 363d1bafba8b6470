"""Words of a column of texts and their hashes, computed with numpy on the bytes of a slice of texts."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at a time; a longer text is a slice of its own. A worker holds some 100 bytes for each of them.
SLICE_BYTES = 1 << 19

#: An odd base and its inverse modulo 2^64, and the constants of a 64-bit finaliser.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_S33 = np.uint64(33)

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> _S33)
    x = x * _MIX[0]
    x ^= x >> _S33
    x *= _MIX[1]
    x ^= x >> _S33
    return x


@lru_cache(maxsize=2)
def _powers(base: int, size: int) -> np.ndarray:
    powers = np.full(size, base, np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers, dtype=np.uint64)


def _powers_for(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(SLICE_BYTES, 1 << (n - 1).bit_length()) + 1
    return _powers(_BASE, size), _powers(_INVERSE, size)


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each segment ``data[start:end]`` of bytes: its polynomial value, mixed with its length."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers, inverses = _powers_for(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    # Bytes are shifted by one so that leading zero bytes count.
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts] + mix((ends - starts).astype(np.uint64)))


class Words:
    """The words of a slice of texts: runs of bytes that are no ASCII white space."""

    def __init__(self, data: np.ndarray, texts_at: np.ndarray):
        self.data, self.texts_at = data, texts_at
        space = np.ones(len(data) + 2, bool)
        space[1:-1] = _SPACE[data]
        # A text ends where the next begins, even without a space.
        begin = ~space[1:-1] & space[:-2]
        inner = texts_at[(texts_at > 0) & (texts_at < len(data))]
        begin[inner] = ~space[1:-1][inner]
        self.starts = np.flatnonzero(begin)
        stop = ~space[1:-1] & space[2:]
        stop[inner - 1] |= ~space[1:-1][inner - 1]
        self.ends = np.flatnonzero(stop) + 1
        #: Words of text k are those from bounds[k] to bounds[k + 1].
        self.bounds = np.searchsorted(self.starts, texts_at)

    def hashes(self) -> np.ndarray:
        return segment_hashes(self.data, self.starts, self.ends)


def text_slices(texts: pa.Array, lower: bool) -> Iterator[tuple[int, int, Words]]:
    """First and last (excluded) text of each slice with its words; null texts have none.

    ``lower`` lower-cases A-Z only.
    """
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    whole = texts.buffers()[2]
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        begin, end = int(offsets[first]), int(offsets[last])
        data = np.frombuffer(whole, np.uint8, end - begin, begin) if end > begin else np.zeros(0, np.uint8)
        yield first, last, Words(_LOWER[data] if lower else data, offsets[first : last + 1] - begin)
        first = last


def windows(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words inside each text, the text of each, and its first word.

    A text of fewer words, but not of none, has one window: all of it.
    """
    counts = np.diff(bounds)
    n = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    text = np.repeat(np.arange(len(counts)), n)
    first = np.arange(int(n.sum())) + np.repeat(bounds[:-1] - (np.cumsum(n) - n), n)
    total = np.zeros(len(first), np.uint64)
    stop = bounds[1:][text]
    for k in range(size):
        inside = first + k < stop
        part = hashes[np.where(inside, first + k, 0)] if len(hashes) else total
        total = mix(total + np.where(inside, part, np.uint64(k + 1)))
    return total, text, first
