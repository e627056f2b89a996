"""Terms of Arrow string columns, by Arrow's compute functions over slices of bounded bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are split at once; one text may be longer.
SLICE_BYTES = 4 * 2**20


def byte_slices(lengths: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, rows) of runs of rows whose lengths add up to ``limit`` at most, one row at least."""
    ends = np.cumsum(lengths)
    a, before = 0, 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield a, b - a
        a, before = b, int(ends[b - 1])


def batch_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    for a, n in byte_slices(lengths.astype(np.int64), limit):
        yield batch.slice(a, n)


def split_terms(text: pa.Array, stops: str) -> tuple[pa.Array, np.ndarray]:
    """(terms in order, row of each): what lies between matches of ``stops``, empty terms left out; null counts as empty."""
    lists = pc.split_pattern_regex(text.fill_null(""), stops)
    terms, rows = pc.list_flatten(lists), pc.list_parent_indices(lists)
    some = pc.greater(pc.binary_length(terms), 0)
    return terms.filter(some), rows.filter(some).to_numpy(zero_copy_only=False).astype(np.int64)
