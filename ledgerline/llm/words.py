"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow batch.

A word is a run of bytes other than blank and the control characters 9 to 13. Words, lines
and shingles are compared by 64-bit hashes: a polynomial of random byte values, finished by a
bit mixer. All functions are deterministic, so tasks that run again give equal values.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Texts are handled in pieces of about this many bytes, which bounds a task's memory; a
# longer text is a piece of its own.
PIECE_BYTES = 512 << 10

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NEWLINE = 10

_random = np.random.Generator(np.random.PCG64(20_24))
BYTE_VALUES = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
# the same values with A to Z read as a to z
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit word (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of values[start:end] for every span, equal for equal spans wherever they are."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(BASE, len(values)), out=sums[1:])
    raw = (sums[ends] - sums[starts]) * powers(INVERSE, len(values) + 1)[starts]
    return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(BASE))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` consecutive values."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    n = len(hashes) - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(BASE) + hashes[k : k + n]
    return mix(out)


def within(offsets: np.ndarray, size: int) -> np.ndarray:
    """Which windows of ``size`` positions lie inside one text; ``offsets`` are text bounds."""
    n = max(0, int(offsets[-1]) - size + 1)
    inside = np.ones(n, bool)
    if n:
        # a window that starts in the last size - 1 positions of a text leaves it
        for k in range(1, size):
            at = offsets[1:-1] - k
            inside[at[(at >= 0) & (at < n)]] = False
    return inside


@dataclass
class Piece:
    """Some texts of a batch: rows ``first`` to ``last``, their bytes and text bounds."""

    first: int
    last: int
    bytes: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return self.last - self.first

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """The sum of a byte-wise flag per text."""
        sums = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=sums[1:])
        return np.diff(sums[self.bounds])


@dataclass
class Words:
    """Byte spans of the words; ``bounds`` are the word positions at which texts begin."""

    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def texts(self) -> np.ndarray:
        """The number of the text of every word."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the bounds of a string column; NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    bounds = np.frombuffer(column.buffers()[1], np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, bounds


def pieces(column: pa.Array) -> Iterator[Piece]:
    """The texts of a column in pieces of bounded size, in order."""
    if not len(column):
        return
    data, bounds = text_buffers(column)
    first = 0
    while first < len(bounds) - 1:
        last = int(np.searchsorted(bounds, bounds[first] + PIECE_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(bounds) - 1)
        own = bounds[first : last + 1]
        yield Piece(first, last, data[own[0] : own[-1]], own - own[0])
        first = last


def find_words(piece: Piece, between: np.ndarray = SPACE) -> Words:
    """Runs of bytes outside ``between``, which no text's end crosses."""
    word = ~between[piece.bytes]
    n = len(word)
    begins = np.zeros(n + 1, bool)
    begins[piece.bounds] = True
    before = np.zeros(n, bool)
    after = np.zeros(n, bool)
    before[1:] = word[:-1]
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | begins[:n]))
    ends = np.flatnonzero(word & (~after | begins[1:])) + 1
    return Words(starts, ends, np.searchsorted(starts, piece.bounds))


def word_hashes(piece: Piece, words: Words, lower: bool) -> np.ndarray:
    values = (LOWER_VALUES if lower else BYTE_VALUES)[piece.bytes]
    return span_hashes(values, words.starts, words.ends)


def per_owner(owners: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owners, minlength=n).astype(np.int64)
