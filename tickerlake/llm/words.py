"""Words and window hashes of whole Arrow batches of texts, as numpy arrays.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; in UTF-8 that is the pattern
``[^\\x20\\x09-\\x0D]+``. Hashes are polynomials modulo 2**64 over all bytes of a word, mixed, and over
the word hashes of a window, mixed again. Every step works on whole arrays; no Python loop runs per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes of text handled at a time, which bounds the arrays; a single longer text is handled alone.
SLICE_BYTES = 1 << 19
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_LENGTH = U64(0xA24BAED4963EE407)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: Powers of each base and of its inverse, as far as most slices need them.
_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_TABLE = 1 << 20


def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    if base in _TABLES and size <= len(_TABLES[base][0]):
        return _TABLES[base]
    size = 1 << max(16, size.bit_length())
    tables = []
    for factor in (base, pow(base, -1, 1 << 64)):
        table = np.full(size, factor, U64)
        table[0] = 1
        tables.append(np.cumprod(table))
    if size <= _TABLE:
        _TABLES[base] = tuple(tables)
    return tuple(tables)


def forget() -> None:
    """Free the tables of powers (up to 32 MB); the next slice makes them again."""
    _TABLES.clear()


def _spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Hash of values[start:end] for each span, equal for equal content wherever it stands."""
    up, down = _powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


@dataclass
class Words:
    """Words of consecutive texts. ``offsets[i]:offsets[i + 1]`` are the words of text i."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray
    text_offsets: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def hashes(self, lower: bool = False, base: int = 0) -> np.ndarray:
        data = self.data
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        h = _spans(data.astype(U64) + U64(1), self.starts, self.ends, _BASES[base])
        return mix(h + (self.ends - self.starts).astype(U64) * _LENGTH)

    def windows(self, size: int) -> np.ndarray:
        """First words of all windows of ``size`` words that lie in one text."""
        if len(self.starts) < size:
            return np.zeros(0, np.int64)
        first = np.arange(len(self.starts) - size + 1)
        text = np.searchsorted(self.offsets, first, side="right") - 1
        return first[first + size <= self.offsets[text + 1]]

    def text_of(self, word: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, word, side="right") - 1


def window_hashes(word_hashes: np.ndarray, first: np.ndarray, size: int | np.ndarray, base: int = 0) -> np.ndarray:
    """Hashes of the windows of ``size`` words that begin at the words ``first``."""
    return mix(_spans(word_hashes, first, first + size, _BASES[base]) + U64(base))


def words_of(data: np.ndarray, text_offsets: np.ndarray) -> Words:
    n = len(data)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    before = np.ones(n, bool)
    after = np.ones(n, bool)
    if n:
        before[1:] = blank[:-1]
        after[:-1] = blank[1:]
        edges = text_offsets[(text_offsets > 0) & (text_offsets < n)]
        before[edges] = True
        after[edges - 1] = True
    starts = np.flatnonzero(~blank & before)
    ends = np.flatnonzero(~blank & after) + 1
    return Words(data, starts, ends, np.searchsorted(starts, text_offsets), text_offsets)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its values; NULL is the empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    """Cut a batch's column of texts into runs of about ``size`` bytes: (first row, row after the last, words)."""
    data, offsets = text_buffers(column)
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + size, side="right")) - 1
        high = min(n, max(high, low + 1))
        yield low, high, words_of(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


def words_of_text(text: str | None) -> Words:
    data = np.frombuffer((text or "").encode(), np.uint8)
    return words_of(data, np.array([0, len(data)]))
