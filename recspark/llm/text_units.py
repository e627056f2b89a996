"""Hashes of the words and shingles of Arrow string columns, by numpy over the raw bytes of a batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_RNG = np.random.Generator(np.random.PCG64(20240101))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.array([1], np.uint64)

#: Bytes of text that are worked on at once; one text may be longer.
SLICE_BYTES = 2 * 2**20


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words under which close inputs part."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power_table(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers)), _BASE, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, byte offsets from 0, bytes) of runs of a string column; null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLICE_BYTES, "right")) - 1)
        b = min(b, len(column))
        yield a, b - a, offsets[a : b + 1] - offsets[a], data[offsets[a] : offsets[b]]
        a = b


def word_hashes(offsets: np.ndarray, data: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words ``[^\\x20\\x09-\\x0D]+`` in order, index of each text's first word with the end last)."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    if lower:
        data = _LOWER[data]
    word = ~_IS_SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] |= word[edges]
    starts = np.flatnonzero(begins)
    bounds = np.searchsorted(starts, offsets).astype(np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64), bounds
    place = np.arange(len(data), dtype=np.int64)
    place[starts[0] :] -= np.repeat(starts, np.diff(np.append(starts, len(data))))
    terms = _BYTE[data]
    place[~word] = 0
    terms *= _power_table(int(place.max()) + 1)[place]
    terms[~word] = 0
    return mixed(np.add.reduceat(terms, starts)), bounds


def shingle_sets(words: np.ndarray, bounds: np.ndarray, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's n-word shingles; with fewer words the whole sequence is one, without words none."""
    if len(words) >= n:
        run = np.zeros(len(words) - n + 1, np.uint64)
        for i in range(n):
            run = mixed(run + words[i : len(words) - n + 1 + i] + np.uint64(i + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= n:
            yield np.unique(run[a : b - n + 1])
        elif b > a:
            h = np.zeros(1, np.uint64)
            for i in range(a, b):
                h = mixed(h + words[i : i + 1] + np.uint64(i - a + 1))
            yield mixed(h + np.full(1, b - a, np.uint64) * _BASE)
        else:
            yield np.zeros(0, np.uint64)


def sets_of(column: pa.Array, n: int, lower: bool = True) -> Iterator[np.ndarray]:
    for _, _, offsets, data in text_slices(column):
        yield from shingle_sets(*word_hashes(offsets, data, lower), n)
