"""Token ids in fixed-length rows: best-fit-decreasing packing with a segment tree over free space.

Each task tokenizes its texts and packs them by windows of a bounded number of tokens, so nothing is shuffled and no
task holds more than a window. A packed row has its ids, the cumulative lengths of its segments, and positions that
start anew with each segment.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Splitting pattern of the vocabulary (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Tokens after which a task packs what it holds; the document that reaches them still belongs to the window.
WINDOW_TOKENS = 2_000_000
#: Fills a row behind its last segment; the vocabulary's free id.
PAD = 50_256

_encodings: dict[str, object] = {}


def encoding(path: str):
    """The byte-level BPE of a rank file, one a process."""
    if path not in _encodings:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[path] = tiktoken.Encoding("packing", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encodings[path]


class FreeSpace:
    """Open bins by free space. A segment tree over the spaces 0..length counts bins and finds the smallest space that is large enough."""

    def __init__(self, length: int):
        self.width = 1 << length.bit_length()
        self.counts = [0] * (2 * self.width)
        self.bins: list[list[int]] = [[] for _ in range(self.width)]

    def add(self, space: int, which: int) -> None:
        self.bins[space].append(which)
        node = self.width + space
        while node:
            self.counts[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(space, bin) of the fullest bin with at least this much space, which leaves the tree."""
        node = self.width + least
        if not self.counts[node]:
            # up to the first ancestor with bins to the right, then down its left side
            while node > 1 and (node & 1 or not self.counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if self.counts[2 * node] else 2 * node + 1
        space = node - self.width
        which = self.bins[space].pop()
        while node:
            self.counts[node] -= 1
            node >>= 1
        return space, which


def best_fit_decreasing(lengths: list[int], length: int) -> list[list[int]]:
    """Bins of indexes whose lengths (1..length) add up to ``length`` at most; the longest go first, each to the fullest bin that has room."""
    free, bins = FreeSpace(length), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = free.take(lengths[i])
        if found is None:
            space, which = length, len(bins)
            bins.append([])
        else:
            space, which = found
        bins[which].append(i)
        if space > lengths[i]:
            free.add(space - lengths[i], which)
    return bins


PACKS = "ids binary, cu_seqlens array<int>, positions binary, doc_ids array<bigint>, parts array<int>, rows array<bigint>"


def _packed(docs: list[tuple[int | None, int, np.ndarray]], length: int) -> Iterator[pa.RecordBatch]:
    segments = [(d, k, ids[a : a + length], row) for d, row, ids in docs for k, a in enumerate(range(0, len(ids), length))]
    bins = best_fit_decreasing([len(s[2]) for s in segments], length)
    for at in range(0, len(bins), 500):
        ids, ends, places, owners, parts, rows = [], [], [], [], [], []
        for b in bins[at : at + 500]:
            own = [segments[i] for i in b]
            sizes = [len(s[2]) for s in own]
            row = np.full(length, PAD, np.uint16)
            row[: sum(sizes)] = np.concatenate([s[2] for s in own])
            ids.append(row.tobytes())
            ends.append([0, *np.cumsum(sizes).tolist()])
            places.append(np.concatenate([np.arange(n, dtype=np.uint16) for n in [*sizes, length - sum(sizes)]]).tobytes())
            owners.append([s[0] for s in own])
            parts.append([s[1] for s in own])
            rows.append([s[3] for s in own])
        ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        cols = [pa.array(c, t) for c, t in ((ids, pa.binary()), (ends, ints), (places, pa.binary()), (owners, longs), (parts, ints), (rows, longs))]
        yield pa.record_batch(cols, names=[x.split(" ")[0] for x in PACKS.split(", ")])


def pack(docs: DataFrame, length: int = 2048, path: str = TOKENIZER, window: int = WINDOW_TOKENS) -> DataFrame:
    """Rows of ``length`` token ids of the texts of ``docs`` (doc_id, text).

    ids: ``length`` little-endian uint16, padded with PAD; cu_seqlens: where segments begin, and the end of the last;
    positions: uint16 from 0 in each segment and in the padding; doc_ids, parts and rows: each segment's document, its
    number there, and a number of the document's input row, so that ids may be null or repeat. A document longer than ``length`` is split every ``length`` tokens and nothing is dropped. Null and
    empty texts have no tokens and no segment. ``length`` is at most 65535. A null doc_id stays null.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, held, n, row = encoding(path).encode_ordinary, [], 0, TaskContext.get().partitionId() << 40
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text"), strict=True):
                text = text.as_py()
                row += 1
                if not text:
                    continue
                ids = np.array(encode(text), np.uint16)
                held.append((doc_id, row, ids))
                n += len(ids)
                if n >= window:
                    yield from _packed(held, length)
                    held, n = [], 0
        if held:
            yield from _packed(held, length)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PACKS)


def write_packs(docs: DataFrame, out: str, length: int = 2048, path: str = TOKENIZER) -> DataFrame:
    """``pack`` written as Parquet under ``out`` and read back."""
    packs = pack(docs, length, path)
    packs.write.parquet(out)
    return docs.sparkSession.read.schema(packs.schema).parquet(out)


SEGMENTS = "doc_id long, part int, offset int, n_tokens int, ids_crc32 long, positions_reset boolean, row_fill int"


def segments(packs: DataFrame) -> DataFrame:
    """A row per segment of packed rows: its document, part, place, length, checksum of its ids, whether its positions count from 0, and the tokens of its row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                ids, places, ends = np.frombuffer(r["ids"], np.uint16), np.frombuffer(r["positions"], np.uint16), r["cu_seqlens"]
                for doc_id, part, a, z in zip(r["doc_ids"], r["parts"], ends[:-1], ends[1:], strict=True):
                    reset = bool((places[a:z] == np.arange(z - a)).all())
                    out.append((doc_id, part, a, z - a, zlib.crc32(ids[a:z].tobytes()), reset, ends[-1]))
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int32()]
            cols = list(zip(*out, strict=True)) or [[] for _ in types]
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=[x.split(" ")[0] for x in SEGMENTS.split(", ")])

    return packs.mapInArrow(run, SEGMENTS)


def detokenized(spark: SparkSession, packs: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """(doc_id, text) of the rows that packed rows hold, from all their parts; rows without tokens aren't there."""
    pieces = packs.select(F.posexplode("rows").alias("i", "row"), "doc_ids", "parts", "cu_seqlens", "ids")
    at, end = F.get("cu_seqlens", F.col("i")), F.get("cu_seqlens", F.col("i") + 1)
    pieces = pieces.select("row", F.get("doc_ids", F.col("i")).alias("doc_id"), F.get("parts", F.col("i")).alias("part"), F.substring("ids", 2 * at + 1, 2 * (end - at)).alias("piece"))
    whole = pieces.groupBy("row").agg(F.any_value("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("part", "piece"))).alias("p"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = encoding(path).decode
        for b in batches:
            texts = [decode(np.frombuffer(b"".join(x["piece"] for x in p), np.uint16).tolist()) for p in b.column("p").to_pylist()]
            yield pa.record_batch([b.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return whole.mapInArrow(run, "doc_id long, text string")
