"""Words of many texts by a table of word bytes, a bounded slice of text at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from gleanery.llm.words import _LOWER, _sums, mix, parts


def byte_table(ranges: list[tuple[int, int]]) -> np.ndarray:
    """Which bytes lie in one of the (inclusive) ranges."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


#: Letters and digits of ASCII and all bytes of other characters.
ALPHANUMERIC = byte_table([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])


class Tokens:
    """The words of a slice of texts, A to Z lower-cased.

    Word i is ``data[starts[i]:ends[i]]`` and belongs to text ``row[i]``.  ``piece`` is
    equal for words with no break byte and no text border between them.  Words before
    ``fresh`` belong to the slice before this one; ``place`` is the number of words of
    the text before word 0, if the slice begins inside a text.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, word: np.ndarray, breaks: np.ndarray | None):
        self.data, self.offsets = _LOWER[data], offsets
        self.fresh = self.place = 0
        size, inside = len(data), word[data]
        begins, stops = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
        begins[:size] = inside
        begins[1:size] &= ~inside[:-1]
        stops[1:] = inside
        stops[1:size] &= ~inside[1:]
        borders = offsets[(offsets > 0) & (offsets < size)]
        begins[borders] = inside[borders]
        stops[borders] = inside[borders - 1]
        self.inside = inside
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops)
        self.row = np.searchsorted(offsets, self.starts, "right") - 1
        if breaks is not None:
            self.piece = np.cumsum(breaks[data])[self.starts] + self.row if size else self.row

    def __len__(self) -> int:
        return len(self.starts)

    def strings(self) -> pa.Array:
        ends = np.r_[0, np.cumsum(self.ends - self.starts)].astype(np.int64)
        return pa.LargeStringArray.from_buffers(
            len(self), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(self.data[self.inside]))
        )

    def codes(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, and the different words that the numbers stand for."""
        coded = self.strings().dictionary_encode()
        return coded.indices.to_numpy().astype(np.int64), coded.dictionary

    def hashes(self) -> np.ndarray:
        sizes = (self.ends - self.starts).astype(np.uint64)
        return mix(_sums(self.data.astype(np.uint64) + np.uint64(1), self.starts, self.ends) + sizes)


def hashed(strings: pa.Array) -> np.ndarray:
    """64-bit hashes of the strings, by the same rule in every task."""
    offsets, data = _buffers(strings)
    n = (offsets[1:] - offsets[:-1]).astype(np.uint64)
    return mix(_sums(data.astype(np.uint64) + np.uint64(1), offsets[:-1], offsets[1:]) + n)


def _buffers(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    strings = strings.cast(pa.large_string())
    offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = np.frombuffer(strings.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], data


def slices(
    texts: pa.Array, size: int, word: np.ndarray, breaks: np.ndarray | None = None, overlap: int = 0
) -> Iterator[tuple[int, Tokens]]:
    """Slices of about ``size`` bytes as ``(number of the first text, its words)``.

    A longer text comes in several slices that are cut between words; each begins with the
    last ``overlap`` words of the one before.  A null text counts as empty.
    """
    done = 0
    for part in parts(texts, size):
        offsets, data = _buffers(part.cast(pa.large_string()).fill_null(""))
        if len(part) > 1 or len(data) <= size:
            yield done, Tokens(data, offsets, word, breaks)
        else:
            at = own = place = 0
            while own < len(data) or not len(data):
                end = own + size
                while end < len(data):  # on to the end of the word
                    rest = word[data[end : end + 4096]]
                    if not rest.all():
                        end += int(rest.argmin())
                        break
                    end += len(rest)
                end = min(end, len(data))
                tokens = Tokens(data[at:end], np.array([0, end - at]), word, breaks)
                tokens.fresh = int(np.searchsorted(tokens.starts, own - at))
                tokens.place = place
                yield done, tokens
                kept = min(overlap, len(tokens))
                place += len(tokens) - kept
                at = at + int(tokens.starts[len(tokens) - kept]) if kept else end
                own = end
        done += len(part)
