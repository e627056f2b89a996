"""Quality classifier: learned vectors of hashed word and character n-grams, averaged per document, with softmax output.

A document's features are its words, the character n-grams of each word in angle brackets, and one feature for any word that
follows itself, whatever the word; there are no other word n-grams. The vectors and the output weights are trained together by numpy
stochastic gradient descent. As the output is linear in the average, a trained model reduces to one number a bucket, and a
text is scored from its words' sums.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.llm.packed import pack, packed_rows, unpack
from recspark.llm.text_units import mixed

BUCKETS = 1 << 17
DIM = 8
#: Lengths of character n-grams, the angle brackets included.
GRAMS = (3, 4)
#: Labelled documents that are learned from at most, chosen by a hash of their ids.
TRAIN_ROWS = 3000
#: Words whose sums a Python worker keeps at most; then it starts anew.
CACHE_WORDS = 400_000

_ODD = mixed(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)
#: The pair of any word with itself.
_SAME = int(mixed(np.array([77], np.uint64))[0] >> np.uint64(47))


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all words in order, number of features of each word): the word itself and its character n-grams."""
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], np.int64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    terms = mixed(chars + np.uint64(1)) * _spread(lengths, starts)
    parts, owners = [mixed(np.add.reduceat(terms, starts))], [np.arange(len(words))]
    owner = np.repeat(np.arange(len(words)), lengths)
    for g in GRAMS:
        if len(chars) < g:
            continue
        h = np.zeros(len(chars) - g + 1, np.uint64)
        for i in range(g):
            h = h + (chars[i : len(chars) - g + 1 + i] + np.uint64(1)) * _ODD[i]
        inside = np.flatnonzero(owner[: len(h)] == owner[g - 1 :])
        parts.append(mixed(h[inside] + np.uint64(g)))
        owners.append(owner[inside])
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    ids = (np.concatenate(parts)[order] >> np.uint64(47)).astype(np.int64)
    return ids, np.bincount(owners, minlength=len(words))


def _spread(lengths: np.ndarray, starts: np.ndarray) -> np.ndarray:
    place = (np.arange(int(lengths.sum())) - np.repeat(starts, lengths)).astype(np.uint64)
    return mixed(place + np.uint64(0x51ED270B)) | np.uint64(1)


def feature_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(distinct buckets in order, whole-number weight of each) of a text; both empty for a text without words."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    counts = Counter(words)
    ids, sizes = word_features(list(counts))
    weight = np.repeat(np.fromiter(counts.values(), np.float64, len(counts)), sizes)
    same = sum(map(eq, words, islice(words, 1, None)))
    total = np.bincount(np.append(ids, _SAME), weights=np.append(weight, float(same) * SAME_WEIGHT), minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at, total[at].astype(np.int64)


def document_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(distinct buckets, share of each) of a text; both empty for a text without words."""
    at, total = feature_counts(text)
    return at.astype(np.int32), (total / max(1, total.sum())).astype(np.float32)


#: Features that one repetition of a word counts as.
SAME_WEIGHT = 4.0


@dataclass
class Model:
    """score(text) = 1 / (1 + exp(-(mean over features of value[bucket] + bias)))."""

    value: np.ndarray
    bias: float


def train(texts: list[str], labels: list[int], **how) -> Model:
    """``train_rows`` of texts."""
    return train_rows([document_features(x) for x in texts], labels, **how)


def train_rows(rows: list[tuple[np.ndarray, np.ndarray]], labels: list[int], epochs: int = 6, rate: float = 0.4, seed: int = 1) -> Model:
    """Stochastic gradient descent on the cross-entropy of a two-way softmax over averaged vectors; rows as ``document_features`` gives them, labels 1 and 0.

    Without rows of both labels the bias alone answers: the share of label 1, or one half without any row.
    """
    share = (sum(labels) + 1) / (len(labels) + 2)
    flat = Model(np.zeros(BUCKETS, np.float64), float(np.log(share / (1 - share))))
    if len(set(labels)) < 2:
        return flat
    rng = np.random.Generator(np.random.PCG64(seed))
    vectors = ((rng.random((BUCKETS, DIM), dtype=np.float32) - 0.5) / DIM).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    steps, done = epochs * len(rows), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, weight = rows[i]
            lr = rate * (1 - done / steps)
            done += 1
            hidden = weight @ vectors[at]
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = out @ p
            out -= lr * np.outer(hidden, p)
            bias -= lr * p
            vectors[at] -= (lr * VECTOR_RATE) * weight[:, None] * back[None, :]
    change = (out[:, 1] - out[:, 0]).astype(np.float64)
    return Model(vectors.astype(np.float64) @ change, float(bias[1] - bias[0]))


#: The vectors' steps are larger than the output's, as a document moves each by its share only.
VECTOR_RATE = 30.0


class Scorer:
    """Scores of whole texts; the sums of words seen are kept."""

    def __init__(self, model: Model):
        self.model = model
        self.known: dict[str, tuple[float, float]] = {}

    def learn(self, words: list[str]) -> None:
        ids, sizes = word_features(words)
        sums = np.add.reduceat(self.model.value[ids], np.cumsum(sizes) - sizes)
        self.known.update(zip(words, zip(sums.tolist(), sizes.tolist(), strict=True), strict=True))

    def scores(self, texts: list[str]) -> np.ndarray:
        docs, fresh = [], set()
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        for t in texts:
            words = t.split()
            counts = Counter(words)
            fresh.update(w for w in counts if w not in self.known)
            docs.append((counts, SAME_WEIGHT * sum(map(eq, words, islice(words, 1, None)))))
        if fresh:
            self.learn(sorted(fresh))
        known, out = self.known, np.empty(len(texts))
        for i, (counts, same) in enumerate(docs):
            pairs = np.array([known[w] for w in counts]).reshape(-1, 2)
            times = np.fromiter(counts.values(), np.float64, len(counts))
            total, n = times @ pairs[:, 0] + same * self.model.value[_SAME], times @ pairs[:, 1] + same
            out[i] = self.model.bias + (total / n if n else 0.0)
        return 1 / (1 + np.exp(-out))


def _labelled_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, label, features): buckets as gaps, and weights, packed to some two bytes a feature."""
    for b in batches:
        for i, text in enumerate(b.column("text")):
            at, total = feature_counts(text.as_py() or "")
            one = b.slice(i, 1)
            yield pa.record_batch([one.column("doc_id"), one.column("label"), pa.array([pack(np.diff(at, prepend=0), total)], pa.binary())], names=["doc_id", "label", "features"])


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packed, labels = [], []
    for b in batches:
        labels += b.column("label").to_pylist()
        packed += b.column("features").to_pylist()
    ends = np.cumsum([0] + [packed_rows(x) for x in packed])
    # all features in two arrays, which a worker gives back whole
    at, weight = np.empty(ends[-1], np.int32), np.empty(ends[-1], np.float32)
    for x, a, z in zip(packed, ends[:-1], ends[1:], strict=True):
        gaps, total = unpack(x)
        at[a:z], weight[a:z] = np.cumsum(gaps), total / max(1, total.sum())
    model = train_rows([(at[a:z], weight[a:z]) for a, z in zip(ends[:-1], ends[1:], strict=True)], labels)
    yield pa.record_batch([pa.array([model.value.tobytes()], pa.binary()), pa.array([model.bias])], names=["value", "bias"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", where: Column | None = None, rows: int = TRAIN_ROWS) -> Model:
    """A model from at most ``rows`` labelled documents (doc_id, label 0 or 1), those with the smallest hashes of doc_id.

    Rows without label, or of another value, are left out; of repeated labels of one document the smallest holds, and of
    several texts the first in order. Texts are whole: their features are made where they lie, and one task, which gets ``rows`` rows
    of BUCKETS numbers at most, learns from them. The driver gets the model alone.
    """
    known = labels.where(F.col(label).isin(0, 1) & (where if where is not None else F.lit(True)))
    known = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label")).orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id").limit(rows)
    known = F.broadcast(known)  # ``rows`` rows of an id and a label
    texts = docs.select("doc_id", "text").join(known, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    made = texts.mapInArrow(_labelled_features, "doc_id long, label int, features binary")
    got = made.repartition(1).sortWithinPartitions("doc_id").mapInArrow(_trained, "value binary, bias double").first()
    return Model(np.frombuffer(got["value"], np.float64), got["bias"]) if got else train_rows([], [])


def _score_rows(shared, keep: list[str], out: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for big in batches:
            for at in range(0, big.num_rows, 1000):
                b = big.slice(at, 1000)
                got = scorer.scores([x or "" for x in b.column("text").to_pylist()])
                yield pa.record_batch([*[b.column(c) for c in keep], pa.array(got, pa.float64())], names=[*keep, out])

    return run


def score(docs: DataFrame, model: Model, out: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text between 0 and 1; null and empty texts get the bias's score.

    Other columns pass as they are; one named like ``out`` is replaced. Repeated rows are scored each.
    """
    own = [c for c in docs.columns if c != out]
    docs = docs.select(*[F.col(f"`{c}`") for c in own])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers
    return docs.mapInArrow(_score_rows(shared, own, out), docs.withColumn(out, F.lit(0.0)).schema)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score alone: the text stays in its task."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_score_rows(shared, ["doc_id"], "score"), "doc_id long, score double")
