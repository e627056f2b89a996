"""SentencePiece encoding with N-best segmentation, and decoding.

A text's lattice has an edge for every vocabulary piece that matches at a place, and a path's score is the sum of its
pieces' scores. The forward pass finds the best score up to every place. It is then the exact heuristic of an A-star search
that runs backward from the end: hypotheses leave the queue in the order of their whole paths' scores, so the first N that
reach the start are the N best, and no place is left more than N times.

No piece crosses a word boundary, so the lattice of a text is a chain of its words' lattices; words are searched one
by one and kept, and the N best of the text are merged from them, exactly.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from array import array
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Chunks whose best path, and whose N best, a process keeps; it starts anew when they are full. Longer chunks than CACHE_CHARS aren't kept.
CACHE_WORDS, CACHE_PATHS, CACHE_CHARS = 700_000, 100_000, 64
#: Texts whose chunks are searched together.
SLICE_ROWS = 100
#: What a byte piece scores below the lowest other piece.
BYTE_PENALTY = 10.0

_LOSS = itemgetter(2)

_vocabularies: dict[str, Vocabulary] = {}


class Vocabulary:
    """Pieces and scores of a model file.

    A model of merges ranks its pieces and gives no probabilities: piece i of rank r scores -ln(r + 2), as frequencies
    fall with rank. A model with probabilities keeps its own.
    """

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            model = sentencepiece.SentencePieceProcessor(model_proto=f.read())
        self.piece_of = [model.id_to_piece(i) for i in range(len(model))]
        self.bytes_at: dict[int, int] = {}  # byte value: id
        self.pieces: dict[str, tuple[int, float]] = {}
        ranks = all(model.get_score(i) == int(model.get_score(i)) for i in range(len(model)))
        for i, piece in enumerate(self.piece_of):
            if model.is_byte(i):
                self.bytes_at[int(piece[1:-1], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                rank = max(0.0, -model.get_score(i))
                # pieces that users defined have the lowest rank of all and come first in practice
                self.pieces[piece] = (i, -math.log((0.0 if rank > 10 * len(model) else rank) + 2) if ranks else model.get_score(i))
        # pieces from their ends: character: (id and score of the piece that begins here, or None, what precedes)
        self.tree: dict[str, tuple[tuple[int, float] | None, dict]] = {}
        for piece, own in self.pieces.items():
            here = self.tree
            for c in piece[:0:-1]:
                here = here.setdefault(c, (None, {}))[1]
            here[piece[0]] = own, here.get(piece[0], (None, {}))[1]
        self.unknown = min(s for _, s in self.pieces.values()) - BYTE_PENALTY
        self.raw = [b""] * len(self.piece_of)
        for value, i in self.bytes_at.items():
            self.raw[i] = bytes([value])
        for piece, (i, _) in self.pieces.items():
            self.raw[i] = piece.replace(SPACE, " ").encode()
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("pieces that cross a word boundary need another splitting of texts")


def vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


_CHUNK = re.compile("\n|" + SPACE + "+[^" + SPACE + "\n]*|[^" + SPACE + "\n]+")


def chunks(text: str) -> list[str]:
    """The parts of a text that no piece crosses; a space is put before the text, as in training."""
    return _CHUNK.findall((" " + text).replace(" ", SPACE)) if text else []


class Lattice:
    """The pieces that match in one chunk. Characters without a piece are spelled in bytes.

    The forward pass up to a place depends on the characters before it only, so ``read`` keeps what the chunk shares with
    the one read before; chunks in sorted order share much.
    """

    def __init__(self, voc: Vocabulary):
        self.voc, self.chunk = voc, ""
        self.forward = [0.0]  # best score up to each place
        self.loss = [math.inf]  # how much worse the second best path up to here is; infinite if there is one path only
        self.back = [(0, -1)]  # start and id of the best path's last piece; -1 is spelled in bytes

    def read(self, chunk: str) -> Lattice:
        k, last = 0, self.chunk
        for x, y in zip(chunk, last, strict=False):
            if x != y:
                break
            k += 1
        self.chunk, forward, loss, back, tree = chunk, self.forward, self.loss, self.back, self.voc.tree
        del forward[k + 1 :], loss[k + 1 :], back[k + 1 :]
        for e in range(k, len(chunk)):
            best, other, come, follow = -math.inf, -math.inf, (e, -1), tree
            for s in range(e, -1, -1):
                found = follow.get(chunk[s])
                if found is None:  # no piece ends like this
                    if s == e:
                        best = forward[s] + self._spelled(s)
                    break
                own, follow = found
                if own is not None:
                    total = forward[s] + own[1]
                elif s == e:
                    total = forward[s] + self._spelled(s)
                else:
                    continue
                if total >= best:
                    best, other, come = total, best, (s, own[0] if own is not None else -1)
                elif total > other:
                    other = total
            forward.append(best)
            back.append(come)
            loss.append(min(best - other, loss[come[0]]))
        return self

    def _spelled(self, s: int) -> float:
        return self.voc.unknown * len(self.chunk[s].encode("utf-8", "surrogatepass"))

    def edges_into(self, e: int) -> Iterator[tuple[int, int, float]]:
        """(start, id, score) of the pieces that end at a place."""
        follow = self.voc.tree
        for s in range(e - 1, -1, -1):
            own, follow = follow.get(self.chunk[s], (None, {}))
            if own is not None:
                yield s, *own
            elif s == e - 1:
                yield s, -1, self._spelled(s)
            if not follow:
                break

    def ids(self, cuts) -> list[int]:
        """Ids of a path given as (start, id) of its pieces."""
        out = []
        for s, i in cuts:
            out += [i] if i >= 0 else [self.voc.bytes_at[x] for x in self.chunk[s].encode("utf-8", "surrogatepass")]
        return out

    def best(self) -> list[int]:
        """Ids of the best path."""
        cuts, e = [], len(self.chunk)
        while e:
            cuts.append(self.back[e])
            e = self.back[e][0]
        return self.ids(reversed(cuts))

    def n_best(self, n: int) -> list[tuple[float, list[int]]]:
        """(score, ids) of the ``n`` best paths, best first: backward A-star with the forward scores as its heuristic.

        Hypotheses leave the queue in the order of their whole paths' scores, so of those at one place only the first
        ``n`` can be part of the ``n`` best; no more are followed. Time and memory are that of ``n`` times the lattice.
        """
        taken, found, made = [0] * (len(self.chunk) + 1), [], 0
        # (minus the whole path's score, order of making, place, score from here to the end, pieces from here on)
        queue: list[tuple] = [(-self.forward[-1], 0, len(self.chunk), 0.0, None)]
        while queue and len(found) < n:
            cost, _, e, after, follow = heapq.heappop(queue)
            taken[e] += 1
            if taken[e] > n:
                continue
            if e == 0:
                cuts = []
                while follow is not None:
                    *cut, follow = follow
                    cuts.append(cut)
                found.append((-cost, self.ids(cuts)))
                continue
            for s, i, score in self.edges_into(e):
                if taken[s] < n:
                    made += 1
                    heapq.heappush(queue, (-(self.forward[s] + score + after), made, s, score + after, (s, i, follow)))
        return found


class Encoder:
    """N-best encoding of whole texts; best paths of chunks seen are kept, and the N best of those that were asked for."""

    def __init__(self, path: str = MODEL):
        self.voc = vocabulary(path)
        self.lattice = Lattice(self.voc)
        self.known: dict[str, tuple[bytes, float, float]] = {}
        self.paths: dict[tuple[str, int], list[tuple[float, list[int]]]] = {}

    def _chunk(self, c: str) -> tuple[bytes, float, float]:
        """ids as bytes, score, loss of the second best path."""
        x = self.lattice.read(c)
        found = array("H", x.best()).tobytes(), x.forward[-1], x.loss[-1]
        if len(c) <= CACHE_CHARS:
            self.known[c] = found
        return found

    def batch(self, texts: list[str]) -> Iterator[tuple[list[str], list[tuple[bytes, float, float]]]]:
        """``best`` of each text; the chunks that are new are searched first, in sorted order."""
        if len(self.known) >= CACHE_WORDS:
            self.known.clear()
        parted = [chunks(t) for t in texts]
        fresh = {c for parts in parted for c in parts if c not in self.known and len(c) <= CACHE_CHARS}
        for c in sorted(fresh):
            self._chunk(c)
        for parts in parted:
            yield self._found(parts)

    def _paths(self, c: str, n: int) -> list[tuple[float, list[int]]]:
        """The ``n`` best (loss against the best, ids) of a chunk."""
        found = self.paths.get((c, n))
        if found is None:
            best = self.lattice.read(c).n_best(n)
            found = [(max(0.0, best[0][0] - score), ids) for score, ids in best]
            if len(c) <= CACHE_CHARS:
                if len(self.paths) >= CACHE_PATHS:
                    self.paths.clear()
                self.paths[c, n] = found
        return found

    def best(self, text: str) -> tuple[list[str], list[tuple[bytes, float, float]]]:
        """The chunks of a text, and ids as bytes, score and loss of the second best path of each."""
        return self._found(chunks(text))

    def _found(self, parts: list[str]) -> tuple[list[str], list[tuple[bytes, float, float]]]:
        known = self.known
        return parts, [known.get(c) or self._chunk(c) for c in parts]

    def n_best(self, text: str, n: int) -> list[tuple[float, list[int]]]:
        """The ``n`` best segmentations of a whole text, or all there are, as (score, ids), best first."""
        return self._n_best(*self.best(text), n)

    def _n_best(self, parts: list[str], found: list, n: int) -> list[tuple[float, list[int]]]:
        total = sum(f[1] for f in found)
        own = [np.frombuffer(f[0], np.uint16).tolist() for f in found]
        out = []
        for loss, changed in self.merged(parts, found, n):
            ids = [changed[i] if i in changed else x for i, x in enumerate(own)]
            out.append((total - loss, [t for x in ids for t in x]))
        return out

    def merged(self, parts: list[str], found: list, n: int) -> list[tuple[float, dict[int, list[int]]]]:
        """(loss against the best, chunks with other ids) of the ``n`` best segmentations.

        A segmentation picks one path for every chunk. Only the n - 1 chunks whose second paths lose least can differ
        in the n best, since every other choice has n better ones before it; those chunks' paths are merged in turn.
        """
        losses = np.fromiter(map(_LOSS, found), np.float64, len(found))
        able = np.flatnonzero(losses < np.inf)
        if len(able) > n - 1:  # the smallest losses, of equal ones the first
            able = able[losses[able] <= np.partition(losses[able], n - 2)[n - 2]] if n > 1 else able[:0]
            able = np.sort(able[np.argsort(losses[able], kind="stable")[: n - 1]])
        merged: list[tuple[float, dict[int, list[int]]]] = [(0.0, {})]
        for i in able.tolist():
            paths = self._paths(parts[i], n)
            options = [(a + loss, k, j) for k, (a, _) in enumerate(merged) for j, (loss, _) in enumerate(paths)]
            merged = [(loss, merged[k][1] | ({i: paths[j][1]} if j else {})) for loss, k, j in heapq.nsmallest(n, options)]
        return merged

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the space that was put before it."""
        return b"".join(map(self.voc.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encode(docs: DataFrame, n: int = 4, path: str = MODEL) -> DataFrame:
    """``docs`` with pieces: array of struct(score double, ids array<int>), the ``n`` best segmentations of each whole text, best first.

    Null and empty texts have one segmentation without pieces and score 0. Other columns stay; one named pieces is
    replaced. Equal scores are ordered by their cuts, so runs agree.
    """
    own = [c for c in docs.columns if c != "pieces"]
    docs = docs.select(*[F.col(f"`{c}`") for c in own])
    kind = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for big in batches:
            for at in range(0, big.num_rows, SLICE_ROWS):
                b = big.slice(at, SLICE_ROWS)
                texts = [x or "" for x in b.column("text").to_pylist()]
                got = [[{"score": s, "ids": ids} for s, ids in e._n_best(*x, n)] for x in e.batch(texts)]
                yield pa.record_batch([*b.columns, pa.array(got, kind)], names=[*own, "pieces"])

    return docs.mapInArrow(run, docs.withColumn("pieces", F.lit(None).cast("array<struct<score:double,ids:array<int>>>")).schema)


def decode(docs: DataFrame, ids: str = "ids", out: str = "text", path: str = MODEL) -> DataFrame:
    """``docs`` with the text of the array column ``ids`` in ``out``; null ids give null."""
    own = [c for c in docs.columns if c != out]
    docs = docs.select(*[F.col(f"`{c}`") for c in own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for b in batches:
            got = [None if x is None else e.decode(x) for x in b.column(ids).to_pylist()]
            yield pa.record_batch([*b.columns, pa.array(got, pa.string())], names=[*own, out])

    return docs.mapInArrow(run, docs.withColumn(out, F.lit(None).cast("string")).schema)


def encode_and_decode(docs: DataFrame, n: int = 4, path: str = MODEL) -> DataFrame:
    """``docs`` with the ids of each whole text's best segmentation, its score, the losses of the ``n`` best, and text decoded from the ids.

    ids is array<int>; null and empty texts have none, score 0, and come back empty. Columns ids, score and losses of
    the input are replaced, others stay. The mark that stands for a space decodes to a space.
    """
    own = [c for c in docs.columns if c not in ("ids", "score", "losses", "text")]
    docs = docs.select(*[F.col(f"`{c}`") for c in own], "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for big in batches:
            for at in range(0, big.num_rows, SLICE_ROWS):
                b = big.slice(at, SLICE_ROWS)
                parts_of, scores, losses, texts = [], [], [], []
                for parts, found in e.batch([x or "" for x in b.column("text").to_pylist()]):
                    ids = b"".join([f[0] for f in found])
                    parts_of.append(ids)
                    scores.append(sum(f[1] for f in found))
                    losses.append([x for x, _ in e.merged(parts, found, n)])
                    texts.append(e.decode(np.frombuffer(ids, np.uint16).tolist()))
                ends = np.cumsum([0] + [len(x) // 2 for x in parts_of]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts_of), np.uint16).astype(np.int32)))
                yield pa.record_batch([*[b.column(c) for c in own], pa.array(texts, pa.string()), ids, pa.array(scores, pa.float64()), pa.array(losses, pa.list_(pa.float64()))], names=[*own, "text", "ids", "score", "losses"])

    schema = docs.withColumn("ids", F.lit(None).cast("array<int>")).withColumn("score", F.lit(0.0)).withColumn("losses", F.lit(None).cast("array<double>")).schema
    return docs.mapInArrow(run, schema)


DIGEST = "doc_id long, n_pieces int, ids_crc32 long, score double, losses array<double>, alternatives_crc32 array<bigint>, decodes boolean"


def digests(docs: DataFrame, n: int = 4, path: str = MODEL) -> DataFrame:
    """What ``encode`` finds for each row, in short, and whether it decodes to the text.

    n_pieces and ids_crc32 (of little-endian uint16 ids) of the best segmentation, its score, the losses of the ``n``
    best against it, and for each the checksum of the places of changed words and their ids. decodes: the ids give the
    text back, where the mark that stands for a space counts as one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for big, at in ((b, i) for b in batches for i in range(0, b.num_rows, SLICE_ROWS)):
            b, rows = big.slice(at, SLICE_ROWS), []
            texts = [x or "" for x in b.column("text").to_pylist()]
            for doc_id, text, (parts, found) in zip(b.column("doc_id").to_pylist(), texts, e.batch(texts), strict=True):
                others = e.merged(parts, found, n)
                ids = b"".join([f[0] for f in found])
                crcs = [zlib.crc32(repr(sorted(changed.items())).encode()) for _, changed in others]
                back = e.decode(np.frombuffer(ids, np.uint16).tolist())
                rows.append((doc_id, len(ids) // 2, zlib.crc32(ids), sum([f[1] for f in found]), [x for x, _ in others], crcs, back == text.replace(SPACE, " ")))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.bool_()]
            cols = list(zip(*rows, strict=True)) or [[] for _ in types]
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=[x.split(" ")[0] for x in DIGEST.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, DIGEST)
