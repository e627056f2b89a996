"""MurmurHash3 x64_128 (first 64 bits) of many short keys at once.

Spark has no such function, and its arithmetic doesn't wrap, so this is an Arrow UDF over numpy. It is meant for the
distinct keys of a vocabulary, whose hashes are joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the hash and of the encoding.
SEED = 0x3C074A61
C1, C2 = np.uint64(0x87C37B91114253D5), np.uint64(0x4CF5AD432745937F)
FINAL1, FINAL2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
DIM = 2**60


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _final(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * FINAL1
    x = (x ^ (x >> np.uint64(33))) * FINAL2
    return x ^ (x >> np.uint64(33))


def murmur_words(data: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the rows of a uint8 matrix, all of ``length`` bytes."""
    n = len(data)
    padded = np.zeros((n, -(-max(length, 1) // 16) * 16), np.uint8)
    padded[:, :length] = data[:, :length]
    words = padded.view("<u8").astype(np.uint64).reshape(n, -1)
    h1 = np.full(n, SEED, np.uint64)
    h2 = h1.copy()
    for i in range(words.shape[1] // 2):
        low = _turn(words[:, 2 * i] * C1, 31) * C2
        high = _turn(words[:, 2 * i + 1] * C2, 33) * C1
        if i < length // 16:
            h1 = (_turn(h1 ^ low, 27) + h2) * np.uint64(5) + np.uint64(0x52DCE729)
            h2 = (_turn(h2 ^ high, 31) + h1) * np.uint64(5) + np.uint64(0x38495AB5)
        else:  # the rest, padded with zeros, which leave the state as it is
            h1, h2 = h1 ^ low, h2 ^ high
    h1, h2 = h1 ^ np.uint64(length), h2 ^ np.uint64(length)
    h1 = h1 + h2
    h2 = h2 + h1
    return _final(h1) + _final(h2)


def hash_bytes(keys: Sequence[bytes]) -> np.ndarray:
    """Signed hashes of byte strings, worked on by length."""
    out = np.zeros(len(keys), np.int64)
    lengths = np.array([len(k) for k in keys])
    for n in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == n)
        block = np.frombuffer(b"".join(keys[i] for i in at), np.uint8).reshape(len(at), n)
        out[at] = murmur_words(block, n).view(np.int64)
    return out


def hash_keys(parts: np.ndarray, dim: int = DIM) -> np.ndarray:
    """Positions 0..dim-1 of rows of (index, id, index, id, ...), each index 4 and each id 8 little-endian bytes."""
    n, k = parts.shape
    block = np.empty((n, k // 2, 12), np.uint8)
    for i in range(k // 2):
        block[:, i, :4] = np.ascontiguousarray(parts[:, 2 * i].astype("<i4")).view(np.uint8).reshape(n, 4)
        block[:, i, 4:] = np.ascontiguousarray(parts[:, 2 * i + 1].astype("<i8")).view(np.uint8).reshape(n, 8)
    h = murmur_words(block.reshape(n, -1), 6 * k).view(np.int64)
    rest = np.fmod(h, dim)
    return np.where(rest < 0, rest + dim, rest)


def string_id(c: Column) -> Column:
    """The id of a string feature: the hash of its UTF-8 bytes; null for null."""

    @F.pandas_udf("long")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(hash_bytes([b"" if x is None else x.encode() for x in s]))

    return F.when(c.isNotNull(), run(c))


def feature_hash(*parts: Column, dim: int = DIM) -> Column:
    """The hash index of (index, id) pairs: one pair for a categorical feature, more for a cross."""

    @F.pandas_udf("long")
    def run(*series: pd.Series) -> pd.Series:
        return pd.Series(hash_keys(np.stack([s.to_numpy(np.int64) for s in series], axis=1), dim))

    return run(*parts)


def cross_hash(parts: Column, dim: int = DIM) -> Column:
    """The hash index of a cross, from its parents' values (array of field_index, key, fea); null for null.

    A parent's id is its number, or the hash of its key where that is null.
    """

    @F.pandas_udf("long")
    def run(indexes: pd.Series, keys: pd.Series, numbers: pd.Series) -> pd.Series:
        out = np.zeros(len(indexes), np.int64)
        sizes = np.array([0 if x is None else len(x) for x in indexes], np.int64)
        for k in np.unique(sizes[sizes > 0]).tolist():
            at = np.flatnonzero(sizes == k)
            rows = np.empty((len(at), 2 * k), np.int64)
            for i in range(k):
                ids = hash_bytes([keys[r][i].encode() for r in at])
                rows[:, 2 * i] = [indexes[r][i] for r in at]
                rows[:, 2 * i + 1] = [h if numbers[r][i] == "" else int(numbers[r][i]) for r, h in zip(at, ids, strict=True)]
            out[at] = hash_keys(rows, dim)
        return pd.Series(out)

    numbers = F.transform(parts, lambda p: F.coalesce(p["fea"].cast("string"), F.lit("")))
    made = run(F.transform(parts, lambda p: p["field_index"]), F.transform(parts, lambda p: p["key"]), numbers)
    return F.when(parts.isNotNull(), made)
