"""Texts of Arrow batches as numpy arrays: slices of bounded size, words, hashes.

These run inside Spark tasks on a few megabytes at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_MASK = (1 << 64) - 1


def _mix_int(x: int) -> int:
    """splitmix64 on a Python integer."""
    x = (x + 0x9E3779B97F4A7C15) & _MASK
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _MASK
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _MASK
    return x ^ (x >> 31)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser on an array of uint64: a bijection that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_slices(batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of at most `most` bytes of text, but at least one row; nulls become empty texts."""
    for batch in batches:
        k = batch.schema.get_field_index(column)
        text = batch.column(k)
        if text.null_count:
            batch = batch.set_column(k, batch.schema.field(k), pc.fill_null(text, ""))
            text = batch.column(k)
        sizes = np.asarray(pc.cast(pc.binary_length(text), pa.int64()))
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array without nulls, and where each text starts (with the end as last)."""
    wide = np.int64 if pa.types.is_large_string(text.type) else np.int32
    offsets = np.frombuffer(text.buffers()[1], wide)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


#: A-Z to a-z, all else unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of words between white space, as in [^\x20\x09-\x0D]+.
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
#: Bytes of words of ASCII digits, lower-case letters and all characters beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True


def find_words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in `data`, and the number of words before each text (total as last)."""
    m = inside[data]
    if not len(m):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    edge = m.copy()
    edge[1:] &= ~m[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    edge[firsts] = m[firsts]
    starts = np.flatnonzero(edge)
    edge = m.copy()
    edge[:-1] &= ~m[1:]
    lasts = firsts[1:] - 1
    edge[lasts] = m[lasts]
    ends = np.flatnonzero(edge) + 1
    return starts, ends, np.searchsorted(starts, offsets)


class WordHash:
    """A 64-bit hash of byte strings: random values per byte, times powers of an odd number, mixed."""

    def __init__(self, seed: int = 0):
        self.values = np.array([_mix_int(seed * 1000 + i) for i in range(256)], np.uint64)
        self.base = _mix_int(seed * 1000 + 999) | 1
        self.powers = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            steps = np.full(max(n, 64), self.base, np.uint64)
            steps[0] = 1
            self.powers = np.multiply.accumulate(steps)

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if not len(starts):
            return np.zeros(0, np.uint64)
        sizes = ends - starts
        self._grow(int(sizes.max()))
        first = np.cumsum(sizes) - sizes
        within = np.arange(int(sizes.sum()), dtype=np.int64) - np.repeat(first, sizes)
        letters = data[within + np.repeat(starts, sizes)]
        return mix(np.add.reduceat(self.values[letters] * self.powers[within], first) + sizes.astype(np.uint64))


class WindowHash:
    """A hash of every run of `size` consecutive word hashes, from sums of them times powers of an odd number."""

    def __init__(self, size: int, seed: int = 0):
        self.size = size
        self.base = _mix_int(seed * 1000 + 998) | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def __call__(self, words: np.ndarray) -> np.ndarray:
        """One value per start; windows over the end of a text have to be left out by the caller."""
        n = len(words)
        if n < self.size:
            return np.zeros(0, np.uint64)
        if len(self.powers) < n:
            for name, base in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(n + n // 4, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(words * self.powers[:n], out=sums[1:])
        at = n - self.size + 1
        return mix((sums[self.size :] - sums[:at]) * self.inverses[:at])


def window_starts(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of texts with word boundaries `counts` (as from find_words): the starts of all whole windows, and their text."""
    have = np.maximum(np.diff(counts) - size + 1, 0)
    text = np.repeat(np.arange(len(have)), have)
    within = np.arange(len(text)) - np.repeat(np.cumsum(have) - have, have)
    return counts[:-1][text] + within, text


def ragged(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and list sizes."""
    ends = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))
