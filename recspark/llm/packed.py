"""Columns of whole numbers as bytes: the bytes of one place value together, compressed."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length, of numbers from 0 to 2^63 - 1."""
    n = len(columns[0])
    widths = [max(1, (int(c.max(initial=0)).bit_length() + 7) // 8) for c in columns]
    planes = [np.ascontiguousarray(np.ascontiguousarray(c, dtype="<i8").view(np.uint8).reshape(n, 8)[:, :w].T).tobytes() for c, w in zip(columns, widths, strict=True)]
    head = np.array([n, len(columns), *widths], "<i8").tobytes()
    return head + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def unpack(data) -> list[np.ndarray]:
    """The columns that ``pack`` got; ``data`` is bytes or an Arrow buffer."""
    data = memoryview(data)
    n, k = np.frombuffer(data, "<i8", 2).tolist()
    widths = np.frombuffer(data, "<i8", k, offset=16).tolist()
    raw = np.frombuffer(pa.decompress(data[16 + 8 * k :], decompressed_size=n * sum(widths), codec="zstd"), np.uint8)
    out, at = [], 0
    for w in widths:
        column = np.zeros((n, 8), np.uint8)
        column[:, :w] = raw[at : at + n * w].reshape(w, n).T
        out.append(column.view("<i8").reshape(n))
        at += n * w
    return out


def packed_rows(data) -> int:
    """The length of the columns that ``pack`` got."""
    return int(np.frombuffer(memoryview(data), "<i8", 1)[0])
