"""Document fingerprints by consistent weighted sampling.

Each of K samples draws, for every word of a text, numbers r and c from Gamma(2, 1) and b from the unit interval that
the word and the sample alone decide. With the word's count w, t = floor(ln w / r + b), and the word of the smallest
ln a = ln c - r (t - b) - r gives the sample (word, t). Two texts agree in a sample with the probability of the
generalised Jaccard similarity of their word counts, so the share of equal samples estimates it.

Every draw is a hash of word and sample, so distinct words have draws of their own and no table of words is kept; the
draws of a batch's distinct words are made once for all its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.llm.text_units import mixed, text_slices, word_hashes

SAMPLES = 64
#: Distinct words whose draws are held at once.
CHUNK = 1 << 15
#: Rows that a scattering bucket of op6 holds on average.
BUCKET_ROWS = 4000
#: Buckets at most; beyond, they grow, and a bucket is sorted on disk and streamed, never held.
MOST_BUCKETS = 8192

#: Picks the hash. Texts of one small vocabulary share their draws, so the mean error over such texts is one chance value for each seed.
SEED = 1
_SAMPLE = mixed(np.arange(SEED * SAMPLES + 1, (SEED + 1) * SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def _uniform(bits: np.ndarray, shift: int) -> np.ndarray:
    """24 of the bits as numbers inside the unit interval."""
    x = ((bits >> np.uint64(shift)) & np.uint64(0xFFFFFF)).astype(np.float32)
    x += np.float32(0.5)
    x *= np.float32(2.0**-24)
    return x


def _draws(words: np.ndarray, sample: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """r from Gamma(2, 1), b uniform and ln c for c from Gamma(2, 1), for word hashes and sample constants that fit together."""
    h = words * sample
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    b = _uniform(h, 0)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    # the sum of two exponential draws is one from Gamma(2, 1)
    r = -np.log(_uniform(h, 40) * _uniform(h, 12))
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    c = -np.log(_uniform(h, 40) * _uniform(h, 12))
    return r, b, np.log(c)


def _keys(ln_a: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Longs in the order of ``ln_a`` that hold the words' places in their low halves."""
    bits = np.ascontiguousarray(ln_a).view(np.int32)
    bits = bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))
    return (bits.astype(np.int64) << 32) | at[:, None]


def samples_of(texts: list[np.ndarray]) -> np.ndarray:
    """A row of SAMPLES 16-bit codes for the words' hashes of each text; a text without words has the codes of none, all 0."""
    parts = [np.unique(x, return_counts=True) for x in texts]
    every = np.unique(np.concatenate([terms for terms, _ in parts])) if parts else np.zeros(0, np.uint64)
    best = np.full((len(texts), SAMPLES), np.iinfo(np.int64).max)
    for a in range(0, len(every), CHUNK):
        words = every[a : a + CHUNK]
        r, b, ln_c = (np.empty((len(words), SAMPLES), np.float32) for _ in range(3))
        keys = np.empty((len(words), SAMPLES), np.int64)
        for z in range(0, len(words), 256):  # a block that stays in the processor's cache
            block = slice(z, z + 256)
            r[block], b[block], ln_c[block] = _draws(words[block, None], _SAMPLE[None, :])
            # of a word that occurs once: t = floor(b) = 0
            keys[block] = _keys(ln_c[block] + r[block] * (b[block] - 1), np.arange(a + z, a + min(z + 256, len(words))))
        for i, (terms, counts) in enumerate(parts):
            lo, hi = np.searchsorted(terms, words[0], "left"), np.searchsorted(terms, words[-1], "right")
            if lo == hi:
                continue
            at, n = np.searchsorted(words, terms[lo:hi]), counts[lo:hi]
            single, often = at[n == 1], at[n > 1]
            if len(single):
                np.minimum(best[i], np.minimum.reduce(keys[single], axis=0), out=best[i])
            if len(often):
                t = np.floor(np.log(n[n > 1].astype(np.float32))[:, None] / r[often] + b[often])
                ln_a = ln_c[often] - r[often] * (t - b[often]) - r[often]
                np.minimum(best[i], np.minimum.reduce(_keys(ln_a, a + often), axis=0), out=best[i])
    codes = np.zeros((len(texts), SAMPLES), np.uint16)
    full = [i for i, (terms, _) in enumerate(parts) if len(terms)]
    if full:
        found = every[best[full] & 0xFFFFFFFF]
        n = np.array([parts[i][1][np.searchsorted(parts[i][0], words)] for i, words in zip(full, found, strict=True)], np.float32)
        r, b, _ = _draws(found, np.broadcast_to(_SAMPLE, found.shape))
        t = np.where(n > 1, np.floor(np.log(n) / r + b), 0).astype(np.uint64)
        codes[full] = np.maximum(mixed(found + t * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48), np.uint64(1)).astype(np.uint16)
    return codes


def samples(words: np.ndarray) -> np.ndarray:
    """The codes of one text."""
    return samples_of([words])[0]


def words_of(column: pa.Array) -> list[np.ndarray]:
    """The hashes of each text's words, A-Z in lower case; null counts as empty."""
    out = []
    for _, _, offsets, data in text_slices(column):
        words, bounds = word_hashes(offsets, data, lower=True)
        out += [words[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
    return out


def fingerprints(column: pa.Array) -> np.ndarray:
    """A row of samples for each text of a string column; null counts as empty."""
    return samples_of(words_of(column))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, an estimate of generalised Jaccard similarity; two empty texts are alike."""
    return (a == b).mean(axis=-1)


def hexed(rows: np.ndarray) -> list[str]:
    return [r.astype(">u2").tobytes().hex() for r in rows]


def with_fingerprint(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with a string column fingerprint of SAMPLES 16-bit codes in hex; equal texts have equal fingerprints."""
    own = [c for c in docs.columns if c != "fingerprint"]
    docs = docs.select(*[F.col(f"`{c}`") for c in own])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([*b.columns, pa.array(hexed(fingerprints(b.column(column))), pa.string())], names=[*own, "fingerprint"])

    return docs.mapInArrow(run, docs.withColumn("fingerprint", F.lit("")).schema)


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many, or all, of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _edited_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket and place; each is compared with the one after it. The guest that ends a bucket is only compared with."""
    last: tuple | None = None  # (bucket, doc_id, text, guest) and words of the row before
    for big in batches:
        for at in range(0, big.num_rows, 400):
            b = big.slice(at, 400)
            rows = zip(b.column("bucket").to_pylist(), b.column("doc_id").to_pylist(), [x or "" for x in b.column("text").to_pylist()], b.column("guest").to_pylist(), strict=True)
            befores, edits, texts, first = [], [], [] if last is None else [last[1]], last is None
            pairs = []  # places of a row and its follower among ``texts``
            for row, words in zip(rows, words_of(b.column("text")), strict=True):
                texts.append(words)
                if not first and last[0][0] == row[0] and not last[0][3]:
                    befores.append(last[0])
                    edits.append(edited(last[0][2], row[2]))
                    pairs.append(len(texts) - 2)
                last, first = (row, words), False
            if not befores:
                continue
            # a text and its edited form share most words, so their draws are made together
            found = samples_of([*texts, *words_of(pa.array(edits, pa.string()))])
            own, following, new = found[pairs], found[np.array(pairs) + 1], found[len(texts) :]
            yield pa.record_batch([
                pa.array([x[1] for x in befores], pa.int64()),
                pa.array([len(x[2]) for x in befores], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edits]),
                pa.array(hexed(own)),
                pa.array(hexed(new)),
                pa.array(likeness(own, new), pa.float64()),
                pa.array(likeness(own, following), pa.float64()),
            ], names=[x.split(" ")[0] for x in EDITED.split(", ")])


def _range_of(value, cuts: list[int]):
    """How many of the sorted cuts lie below a value, by halving; 0 for null.

    The cuts are one literal and a step reads the place before it as a variable, so the expression's size doesn't grow with the steps.
    """
    if not cuts:
        return F.lit(0)
    array = F.split(F.lit(",".join(str(int(c)) for c in cuts)), ",").cast("array<bigint>")
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])

    def halved(place, step):
        return F.when(F.coalesce(F.get(array, place + (step - 1)) < value, F.lit(False)), place + step).otherwise(place)

    return F.aggregate(steps, F.lit(0), halved)


def compare_with_edits(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Each row of ``docs`` (doc_id, text) with its fingerprint, that of its edited text, and the likenesses.

    The edited text ends in the beginning of the next document by ascending doc_id; after the last comes the first, and
    a single document follows itself. Null ids come first; rows of one id are ordered by their texts' hashes. A null
    text is empty. The texts are shuffled once, into buckets of id ranges that hold some rows each; a bucket also gets
    a copy of the row that follows its last.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_buckets = min(MOST_BUCKETS, max(1, -(-docs.count() // bucket_rows)))
    shares = [i / n_buckets for i in range(1, n_buckets)]
    cuts = sorted(set((docs.agg(F.percentile_approx("doc_id", shares, max(1000, 4 * n_buckets)).alias("c")).first()["c"] if shares else None) or []))
    tie = F.xxhash64("text")
    placed = docs.withColumn("bucket", _range_of(F.col("doc_id"), cuts)).withColumn("tie", tie).withColumn("id", F.coalesce("doc_id", F.lit(-(2**63))))
    heads = placed.groupBy("bucket").agg(F.min(F.struct("id", "tie")).alias("head")).orderBy("bucket").collect()  # MOST_BUCKETS rows of two longs
    turns = [(heads[(i + 1) % len(heads)]["head"]["id"], heads[(i + 1) % len(heads)]["head"]["tie"], r["bucket"]) for i, r in enumerate(heads)]
    guests = F.broadcast(docs.sparkSession.createDataFrame(turns, "id long, tie long, host int"))
    placed = placed.join(guests, ["id", "tie"], "left")
    own, guest = (F.struct(b.alias("bucket"), F.lit(g).alias("guest")) for b, g in ((F.col("bucket"), 0), (F.col("host"), 1)))
    placed = placed.select("id", "doc_id", "tie", "text", F.explode(F.when(F.col("host").isNull(), F.array(own)).otherwise(F.array(own, guest))).alias("at"))
    placed = placed.select("doc_id", "text", "id", "tie", "at.bucket", "at.guest").repartitionById(n_buckets, F.col("bucket"))
    placed = placed.sortWithinPartitions("bucket", "guest", "id", "tie").select("doc_id", "text", "bucket", "guest")
    return placed.mapInArrow(_edited_rows, EDITED)
