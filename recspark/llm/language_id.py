"""Language identification: averaged hashed subword vectors with a linear softmax, trained by numpy, with calibrated rejection.

A text's terms are its runs of letters, lowered. A term's features are the term and its character n-grams in angle brackets, hashed to
buckets; a text is the mean over all features of all its terms. Vectors and output weights are trained together by stochastic
gradient descent on the cross-entropy. As the output is linear in the mean, a trained model is one row of numbers a bucket, and a
text is scored from its distinct terms' sums.

A quarter of the learned rows only calibrates: the temperature that makes the probabilities fit best, and the probability below which
a prediction is rejected: the smallest at which the accepted rows keep to the wanted error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.arrow_terms import batch_slices, split_terms
from recspark.llm.text_units import mixed
from recspark.sources.scratch import counted, written

BITS, DIM = 16, 16
BUCKETS = 1 << BITS
#: Lengths of character n-grams, the angle brackets included.
GRAMS = (2, 3, 4)
#: Documents that are learned from at most, dealt evenly to the commonest languages, of which there are so many at most.
TRAIN_ROWS, MOST_LANGS = 2400, 200
NOT_LETTERS = r"[^\p{L}\p{M}]+"
#: Terms whose sums a Python worker keeps at most; then it starts anew.
CACHE_TERMS = 300_000
UNKNOWN = "und"

_ODD = mixed(np.arange(1, 9, dtype=np.uint64)) | np.uint64(1)


def term_features(terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of all terms in order, number of features of each): the term itself and its character n-grams."""
    marked = pc.binary_join_element_wise("<", terms, ">", "")
    lengths = pc.utf8_length(marked).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = np.frombuffer("".join(marked.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.uint64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    owner = np.repeat(np.arange(len(terms)), lengths)
    place = (np.arange(len(chars)) - starts[owner]).astype(np.uint64)
    whole = np.add.reduceat(mixed(chars + np.uint64(1)) * (mixed(place + np.uint64(0x51ED270B)) | np.uint64(1)), starts)
    parts, owners = [mixed(whole)], [np.arange(len(terms))]
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
    return (np.concatenate(parts)[order] >> np.uint64(64 - BITS)).astype(np.int64), np.bincount(owners, minlength=len(terms))


def split_texts(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(lowered runs of letters, row of each)."""
    return split_terms(pc.utf8_lower(text.fill_null("")), NOT_LETTERS)


@dataclass
class Model:
    """Probabilities are a softmax of ``temperature`` times (mean over features of ``value[bucket]`` + ``bias``)."""

    langs: list[str]
    value: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = (logits - logits.max(axis=1, keepdims=True)) * self.temperature
        p = np.exp(z)
        return p / p.sum(axis=1, keepdims=True)


Row = tuple[str, np.ndarray, np.ndarray]


def train(rows: list[Row], epochs: int = 4, rate: float = 0.5, wanted_error: float = 0.01, seed: int = 3) -> Model:
    """A model of (lang, distinct buckets, share of each); every fourth row calibrates. Without rows nothing can be predicted but ``und``."""
    langs = sorted({r[0] for r in rows})
    k = max(1, len(langs))
    if not langs:
        return Model([UNKNOWN], np.zeros((BUCKETS, 1), np.float32), np.zeros(1, np.float32))
    number = {lang: i for i, lang in enumerate(langs)}
    spared = [r for i, r in enumerate(rows) if i % 4 == 3]
    learned = [r for i, r in enumerate(rows) if i % 4 != 3]
    learned += [r for r in spared if r[0] not in {x[0] for x in learned}]
    rng = np.random.Generator(np.random.PCG64(seed))
    vectors = ((rng.random((BUCKETS, DIM), dtype=np.float32) - 0.5) / DIM).astype(np.float32)
    out, bias = np.zeros((DIM, k), np.float32), np.zeros(k, np.float32)
    steps, done = epochs * len(learned), 0
    for _ in range(epochs):
        for i in rng.permutation(len(learned)):
            lang, at, weight = learned[i]
            lr = rate * (1 - done / steps)
            done += 1
            hidden = weight @ vectors[at]
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[number[lang]] -= 1
            back = out @ p
            out -= lr * np.outer(hidden, p)
            bias -= lr * p
            vectors[at] -= (lr * VECTOR_RATE) * weight[:, None] * back[None, :]
    model = Model(langs, vectors @ out, bias)
    if spared:
        calibrate(model, spared, wanted_error)
    return model


#: The vectors' steps are larger than the output's, as a document moves each by its share only.
VECTOR_RATE = 30.0


def calibrate(model: Model, rows: list[Row], wanted_error: float) -> None:
    """Sets the temperature of the least cross-entropy, and the least probability at which accepted rows err no more than wanted."""
    logits = np.array([weight @ model.value[at] + model.bias for _, at, weight in rows])
    truth = np.array([model.langs.index(lang) for lang, _, _ in rows])

    def loss(t: float) -> float:
        model.temperature = t
        return -float(np.log(np.maximum(model.probabilities(logits)[np.arange(len(rows)), truth], 1e-12)).mean())

    model.temperature = min(np.geomspace(0.25, 8, 41).tolist(), key=loss)
    p = model.probabilities(logits)
    best, wrong = p.max(axis=1), p.argmax(axis=1) != truth
    order = np.argsort(-best, kind="stable")
    fine = np.flatnonzero(np.cumsum(wrong[order]) <= wanted_error * np.arange(1, len(rows) + 1))
    model.least = float(best[order[fine[-1]]]) if len(fine) else 1.0


class _Sums:
    """Sums of the model's rows over each term's features, kept for terms seen."""

    def __init__(self, model: Model):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.string())
        self.sums = np.zeros((0, len(self.model.langs)), np.float64)
        self.sizes = np.zeros(0, np.int64)

    def of(self, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        at = pc.index_in(terms, value_set=self.known)
        new = terms.filter(at.is_null())
        if len(new):
            if len(self.known) + len(new) > CACHE_TERMS and len(self.known):
                self.clear()
                return self.of(terms)
            buckets, sizes = term_features(new)
            sums = np.add.reduceat(self.model.value[buckets].astype(np.float64), np.cumsum(sizes) - sizes, axis=0)
            self.known = pa.concat_arrays([self.known, new])
            self.sums, self.sizes = np.concatenate([self.sums, sums]), np.concatenate([self.sizes, sizes])
            at = pc.index_in(terms, value_set=self.known)
        at = at.to_numpy(zero_copy_only=False)
        return self.sums[at], self.sizes[at]


def predict(text: pa.Array, model: Model, sums: _Sums | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(language, its probability, whether it is accepted) of each text; texts without a letter are unknown, 0 and not accepted."""
    sums = sums or _Sums(model)
    terms, rows = split_texts(text)
    n = len(text)
    total, size = np.zeros((n, len(model.langs))), np.zeros(n)
    if len(terms):
        coded = terms.dictionary_encode()
        per_term, sizes = sums.of(coded.dictionary)
        codes = coded.indices.to_numpy()
        starts = np.flatnonzero(np.diff(rows, prepend=-1))
        for i in range(len(model.langs)):
            total[rows[starts], i] = np.add.reduceat(per_term[codes, i], starts)
        size[rows[starts]] = np.add.reduceat(sizes[codes], starts)
    p = model.probabilities(total / np.maximum(size, 1)[:, None] + model.bias)
    best = p.argmax(axis=1)
    lettered = pc.match_substring_regex(text.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
    score = np.where(lettered, p[np.arange(n), best], 0.0)
    lang = pa.array(model.langs, pa.string()).take(pa.array(np.where(lettered, best, 0)))
    return pc.if_else(pa.array(lettered), lang, UNKNOWN), score, lettered & (score >= model.least)


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, distinct buckets, share of each) of every row: texts stay in their tasks."""
    for big in batches:
        for b in batch_slices(big, "text"):
            terms, rows = split_texts(b.column("text"))
            at, weight = [], []
            bounds = np.searchsorted(rows, np.arange(b.num_rows + 1))
            for i in range(b.num_rows):
                own = terms.slice(bounds[i], bounds[i + 1] - bounds[i])
                if len(own):
                    counts = own.value_counts()
                    buckets, sizes = term_features(counts.field("values"))
                    total = np.bincount(buckets, weights=np.repeat(counts.field("counts").to_numpy(), sizes), minlength=BUCKETS)
                    some = np.flatnonzero(total)
                    at.append(some.astype(np.int32))
                    weight.append((total[some] / total.sum()).astype(np.float32))
                else:
                    at.append(np.zeros(0, np.int32))
                    weight.append(np.zeros(0, np.float32))
            yield pa.record_batch([b.column("lang"), pa.array(at, pa.list_(pa.int32())), pa.array(weight, pa.list_(pa.float32()))], names=["lang", "at", "weight"])


def fit(docs: DataFrame, where: Column | None = None, rows: int = TRAIN_ROWS, most_langs: int = MOST_LANGS) -> Model:
    """A model from at most ``rows`` rows with a language and a text with letters, as many of each of the ``most_langs`` commonest languages.

    Rows are chosen by a hash of doc_id, ties by doc_id and the text's hash; repeats of a row are learned from once. Features are made
    in the tasks, from whole texts; the driver gets BUCKETS numbers a row at most.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = known.where(where) if where is not None else known
    common, n_langs = counted(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(most_langs), "langs")
    narrow = known.select("doc_id", "lang", F.xxhash64("doc_id", F.lit(9)).alias("h"), F.xxhash64("text").alias("t"), "text")
    w = Window.partitionBy("lang").orderBy("h", "doc_id", "t")
    few = narrow.drop("text").withColumn("r", F.row_number().over(w)).where(F.col("r") <= rows // max(1, n_langs))
    chosen = written(few.join(F.broadcast(common.select("lang")), "lang"), "learned")  # ``most_langs`` rows
    on = narrow["lang"].eqNullSafe(chosen["lang"]) & narrow["doc_id"].eqNullSafe(chosen["doc_id"]) & (narrow["t"] == chosen["t"])
    texts = narrow.join(F.broadcast(chosen), on, "left_semi").dropDuplicates(["lang", "doc_id", "t"]).select("lang", "text")  # ``rows`` rows of ids
    got = texts.mapInArrow(_features_of, "lang string, at array<int>, weight array<float>").toArrow()
    made = [(a.as_py(), np.asarray(b.values), np.asarray(c.values)) for a, b, c in zip(got["lang"], got["at"], got["weight"], strict=True)]
    return train(sorted(made, key=lambda r: (r[0], r[1].tobytes(), r[2].tobytes())))


def identify(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with lang_pred, score and accepted for every whole text.

    Null texts and texts without a letter are ``und`` with score 0. ``keep`` may hold no column of those names. Repeated rows are judged each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS times MOST_LANGS numbers at most
    clash = [c for c in keep if c.lower() in ("lang_pred", "score", "accepted")]
    if clash:
        raise ValueError(f"columns {clash} are made here")
    carried = [f"c{i}" for i in range(len(keep))]
    narrow = docs.select(F.col("text").cast("string").alias("text"), *[F.col(f"`{c}`").alias(k) for c, k in zip(keep, carried, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = _Sums(shared.value)
        for big in batches:
            for b in batch_slices(big, "text"):
                lang, score, accepted = predict(b.column("text"), shared.value, sums)
                yield pa.record_batch([*[b.column(k) for k in carried], lang, pa.array(score), pa.array(accepted)], names=[*carried, "lang_pred", "score", "accepted"])

    schema = narrow.drop("text").withColumns({"lang_pred": F.lit(""), "score": F.lit(0.0), "accepted": F.lit(True)}).schema
    return narrow.mapInArrow(run, schema).withColumnsRenamed(dict(zip(carried, keep, strict=True)))
