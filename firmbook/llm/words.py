"""Words and window fingerprints of whole texts, as numpy arrays inside a task.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return. Texts are worked on in slices of about SLICE_BYTES, a
single text never cut, so memory follows the slice and the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_MASK = (1 << 64) - 1


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown when longer ones are asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, size, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, size, 1 << 64))])
        return self.up[:n], self.down[:n]


_BYTE_POWERS, _WORD_POWERS = map(_Powers, _BASES)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of a slice of texts; word i lies in data[starts[i]:ends[i]], text d has words first[d]:first[d + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def _hashes(self) -> np.ndarray:
        up, down = _BYTE_POWERS(len(self.data) + 1)
        sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODES[self.data] * up[:-1], out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * down[self.starts])

    def hashes(self) -> np.ndarray:
        """A 64-bit fingerprint of each word."""
        return self._hashes

    def strings(self) -> pa.Array:
        """The words themselves."""
        lengths = self.ends - self.starts
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(offsets[-1]) + np.repeat(self.starts - offsets[:-1], lengths)
        buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.data[at])]
        return pa.Array.from_buffers(pa.large_string(), len(lengths), buffers)

    def windows(self, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Rabin-Karp fingerprints of all windows of `size` words, and the first window of each text.

        short: a text with fewer words, but some, has its whole sequence as one window.
        """
        hashes, counts = self.hashes(), self.counts
        up, down = _WORD_POWERS(len(hashes) + 1)
        sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * up[:-1], out=sums[1:])
        numbers = np.maximum(counts - size + 1, 0)
        if short:
            numbers = np.where((counts > 0) & (counts < size), 1, numbers)
        first = np.concatenate([[0], np.cumsum(numbers)])
        at = np.arange(first[-1]) + np.repeat(self.first[:-1] - first[:-1], numbers)
        length = np.repeat(np.minimum(counts, size), numbers)
        found = (sums[at + length] - sums[at]) * down[at]
        return mix(found + length.astype(np.uint64)), first


def split(texts: pa.Array, lower: bool = False, blank: np.ndarray = _BLANK) -> Words:
    """The words of some texts; null counts as empty. lower: A-Z become a-z. blank: which bytes are no part of a word."""
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    data = _LOWER[data] if lower else data
    inside = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(blank[data], out=inside[1:-1])
    begins, stops = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    full = offsets[:-1] < offsets[1:]
    begins[offsets[:-1][full]] = inside[1:-1][offsets[:-1][full]]
    stops[offsets[1:][full] - 1] = inside[1:-1][offsets[1:][full] - 1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in pieces with about SLICE_BYTES of text, or a single longer one."""
    for batch in batches:
        texts = batch.column(column).fill_null("").cast(pa.large_string())
        ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        at = 0
        while at < len(batch):
            to = int(np.searchsorted(ends, ends[at] + SLICE_BYTES, side="right")) - 1
            to = min(max(to, at + 1), len(batch))
            yield batch.slice(at, to - at)
            at = to
