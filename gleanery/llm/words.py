"""Words and runs of words of many texts at once, as 64-bit hashes in NumPy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are turned into arrays at a time (a longer text comes alone); the
#: arrays take some forty times as much.
PART = 1 << 19
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.ndarray:
    """base to the power 0, 1, ... n - 1, modulo 2 to the 64."""
    if base not in _powers or len(_powers[base]) < n:
        factors = np.full(max(n, PART + 1), base, np.uint64)
        factors[0] = 1
        _powers[base] = np.multiply.accumulate(factors)
    return _powers[base][:n]


def _sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end] for each start and end, by prefix sums."""
    n = len(values)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(values * _power(_BASE, n), out=prefix[1:])
    back = _power(pow(_BASE, -1, 1 << 64), n + 1)
    return (prefix[ends] - prefix[starts]) * back[starts]


def runs(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each word on; none where fewer are left."""
    n = max(0, len(words) - length + 1)
    starts = np.arange(n)
    return mix(_sums(words, starts, starts + length) + np.uint64(length))


def parts(texts: pa.Array, size: int = PART) -> Iterator[pa.Array]:
    """Slices of the array of about ``size`` bytes."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield texts.slice(first, last - first)
        first = last


class Words:
    """The words of some texts: ``data[starts[i]:ends[i]]``, those of text t from
    ``first[t]`` to ``first[t + 1]``.  A null text has none."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        self.data = _LOWER[data] if lower else data
        size, word = len(data), ~_SEPARATOR[data]
        begins, stops = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        begins[:size] = word
        begins[1:size] &= ~word[:-1]
        stops[1:] = word
        stops[1:size] &= ~word[1:]
        borders = offsets[(offsets > 0) & (offsets < size)]
        begins[borders] = word[borders]
        stops[borders] = word[borders - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops)
        self.first = np.searchsorted(self.starts, offsets)

    def hashes(self) -> np.ndarray:
        sizes = (self.ends - self.starts).astype(np.uint64)
        return mix(_sums(self.data.astype(np.uint64) + np.uint64(1), self.starts, self.ends) + sizes)
