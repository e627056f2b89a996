"""Phrase collocation mining: phrases of 2 to 5 words that occur far more often than their parts would meet by chance.

1. Tasks cut texts into pieces and words and pack them into shards: word ids of the shard's own dictionary, 0 between pieces.
2. Words are counted over all shards. Rare words can be part of no candidate; where they stand a shard's sequence is cut.
3. Each shard is indexed (``phrase_index``) and gives its pairs of words with counts; counts are summed across shards. Then the
   sequence is cut between the words of rare pairs, and what is left is indexed for phrases of 2 to 5 words. So a shard gives only
   phrases whose words, then pairs, are frequent over all shards, which costs no phrase that is. Phrases are rows of word numbers,
   dealt to buckets by hash and packed, a part for each shard and bucket; a bucket sums its parts.
4. A phrase that every occurrence continues by one same word, to one side, lies in a longer candidate as frequent as itself. Each
   shard gives that word for its own occurrences, and the phrase goes if all shards agree. That is the whole test: if any longer
   candidate holds the phrase as often, so does the one that is a word longer.
5. Each cut of a candidate looks up its two parts' counts. The lowest-scoring cut is the candidate's.

Null texts count as empty and null languages as ``und``. Repeated rows count each. Ties go by smaller cut, larger count and the phrase's
bytes. Other columns are ignored. An empty table gives no rows. A worker holds one shard: SHARD_WORDS words, or one longer piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.arrow_terms import SLICE_BYTES, batch_slices, byte_slices, split_terms
from recspark.llm.packed import pack, unpack
from recspark.llm.phrase_index import pairs, phrases
from recspark.llm.text_units import mixed
from recspark.sources.scratch import counted, written

PIECE_ENDS = "[.,;:!?\\x0A-\\x0D]"
BLANKS = "[ \\t]+"
#: Words of a shard, at which it ends.
SHARD_WORDS = 1 << 20
LONGEST = 5
#: Words of the corpus for each bucket that pairs, then phrases, are summed in.
BUCKET_WORDS = 1 << 20
#: Languages up to which their word totals are broadcast.
BROADCAST_LANGS = 10_000

_SHARD = "shard long, words array<struct<lang:string,word:string,n:bigint>>, seq binary"
_SHARD_ARROW = pa.schema([("shard", pa.int64()), ("words", pa.list_(pa.struct([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))), ("seq", pa.binary())])


class _Shard:
    """Words of pieces until there are enough for a shard."""

    def __init__(self):
        self.words: list[pa.Array] = []
        self.langs: list[pa.Array] = []
        self.pieces: list[np.ndarray] = []
        self.n_words = self.n_pieces = 0

    def add(self, words: pa.Array, piece: np.ndarray, langs: pa.Array) -> None:
        """Words in order, the piece and the language of each; pieces count from 0."""
        self.words.append(words)
        self.langs.append(langs)
        self.pieces.append(piece + self.n_pieces)
        self.n_words += len(words)
        self.n_pieces += int(piece[-1]) + 1

    def row(self, number: int) -> pa.RecordBatch:
        word = pa.chunked_array(self.words).combine_chunks().dictionary_encode()
        lang = pa.chunked_array(self.langs).combine_chunks().dictionary_encode()
        pair = lang.indices.to_numpy().astype(np.int64) * len(word.dictionary) + word.indices.to_numpy()
        keys, ids, counts = np.unique(pair, return_inverse=True, return_counts=True)
        # frequent words get small ids, which pack well
        order = np.argsort(-counts, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        keys, ids, counts = keys[order], place[ids], counts[order]
        of_lang, of_word = np.divmod(keys, len(word.dictionary))
        entry = pa.StructArray.from_arrays([lang.dictionary.take(pa.array(of_lang)), word.dictionary.take(pa.array(of_word)), pa.array(counts)], names=["lang", "word", "n"])
        piece = np.concatenate(self.pieces)
        seq = np.zeros(len(ids) + int(np.count_nonzero(np.diff(piece))) + 2, np.int64)
        seq[np.arange(len(ids)) + np.cumsum(np.diff(piece, prepend=-1) != 0)] = ids + 1
        words = pa.ListArray.from_arrays(pa.array([0, len(entry)], pa.int32()), entry)
        return pa.record_batch([pa.array([number]), words, pa.array([pack(seq)])], schema=_SHARD_ARROW)


def make_shards(batches: Iterator[pa.RecordBatch], shard_words: int = SHARD_WORDS) -> Iterator[pa.RecordBatch]:
    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 32
    shard = _Shard()
    for big in batches:
        for b in batch_slices(big, "text"):
            pieces, rows = split_terms(pc.ascii_lower(b.column("text")), PIECE_ENDS)
            lengths = pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
            for at, n in byte_slices(lengths, SLICE_BYTES // 4):
                words, piece = split_terms(pieces.slice(at, n), BLANKS)
                if not len(words):
                    continue
                shard.add(words, piece, b.column("lang").take(pa.array(rows[at + piece])))
                if shard.n_words >= shard_words:
                    yield shard.row(number)
                    shard, number = _Shard(), number + 1
    if shard.n_words:
        yield shard.row(number)


def _only(seq: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """``seq`` with the given ids as 1, 2, … in their order, and one 0 for each run of others."""
    to = np.zeros(int(max(seq.max(), ids.max())) + 1, np.int64)
    to[ids] = np.arange(1, len(ids) + 1)
    return _joined(to[seq])


def _joined(seq: np.ndarray) -> np.ndarray:
    """``seq`` with one 0 for each run of zeros, and at both ends."""
    seq = np.concatenate([[0], seq, [0]])
    return seq[np.append(True, (seq[1:] != 0) | (seq[:-1] != 0))]


def _cut_between(seq: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """``seq`` cut between two ids that aren't one of the sorted ``pairs`` (first * size + second); ids outside all pairs go."""
    size = int(seq.max()) + 1
    keys = seq[:-1] * size + seq[1:]
    place = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
    linked = pairs[place] == keys
    keep = np.append(linked, False) | np.append(False, linked)
    return _joined(np.insert(np.where(keep, seq, 0), np.flatnonzero(~linked) + 1, 0))


def _seq(shard: pa.Table) -> np.ndarray:
    return unpack(shard["seq"][0].as_buffer())[0]


_PART = "bucket long, shard long, part binary"


def _dealt(shard: int, rows: np.ndarray, n_keys: int, buckets: int) -> pa.Table:
    """Rows of numbers, dealt to buckets by a hash of their first ``n_keys`` columns and packed: a part for each bucket."""
    h = np.zeros(len(rows), np.uint64)
    for c in range(n_keys):
        h = mixed(h + rows[:, c].astype(np.uint64) + np.uint64(c + 1))
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bounds = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
    parts = [pack(*rows[order[a:b]].T) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return pa.table({"bucket": bucket[order[bounds[:-1]]], "shard": np.full(len(parts), shard), "part": pa.array(parts, pa.binary())})


def _gathered(parts: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(rows of all parts, the part of each row)."""
    rows = [np.stack(unpack(p.as_buffer()), axis=1) for p in parts["part"]]
    return np.concatenate(rows), np.repeat(np.arange(len(rows)), [len(r) for r in rows])


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first row of each distinct row of ``keys``, the group of each row)."""
    group = np.zeros(len(keys), np.int64)
    for c in range(keys.shape[1]):
        rank = np.unique(keys[:, c], return_inverse=True)[1]
        group = np.unique(group * (int(rank.max(initial=0)) + 1) + rank, return_inverse=True)[1]
    return np.unique(group, return_index=True)[1], group


def shard_pairs(shard: pa.Table, known: pa.Table, buckets: int) -> pa.Table:
    """The pairs of frequent words of one shard, (first, second, n), in parts; ``known`` are its frequent words, by their ids in it and over all shards."""
    empty = pa.table({"bucket": pa.array([], pa.int64()), "shard": pa.array([], pa.int64()), "part": pa.array([], pa.binary())})
    if not len(shard) or not len(known):
        return empty
    seq = _only(_seq(shard), known["id"].to_numpy())
    first, second, n = pairs(seq)
    word = known["word_id"].to_numpy()
    return _dealt(shard["shard"][0].as_py(), np.stack([word[first - 1], word[second - 1], n], axis=1), 2, buckets) if len(n) else empty


_LINKS = "shard long, links binary"


def frequent_links(parts: pa.Table, least: int) -> pa.Table:
    """Of one bucket the pairs that all shards together hold ``least`` times, for each shard that holds them."""
    rows, part = _gathered(parts)
    _, group = _groups(rows[:, :2])
    often = np.bincount(group, weights=rows[:, 2])[group] >= least
    shard, out = parts["shard"].to_pylist(), []
    rows, part = rows[often], part[often]
    for a, b in zip(*(np.searchsorted(part, np.arange(len(shard)), side) for side in ("left", "right")), strict=True):
        out.append(pack(rows[a:b, 0], rows[a:b, 1]) if b > a else None)
    made = pa.table({"shard": pa.array(shard, pa.int64()), "links": pa.array(out, pa.binary())})
    return made.filter(made["links"].is_valid())


def shard_phrases(shard: pa.Table, known: pa.Table, buckets: int, longest: int = LONGEST) -> pa.Table:
    """The phrases of one shard, from two words on, all of whose pairs are frequent, in parts: words, then 0 up to ``longest``, count, left, right.

    ``known`` holds the shard's frequent words (id, word_id) and then its frequent pairs (links). Left and right are the only word to
    that side, 0 where there is none or several.
    """
    is_word = pc.is_valid(known["id"])
    words, links = known.filter(is_word), known.filter(pc.invert(is_word))["links"]
    if not len(shard) or not len(links):
        return shard_pairs(shard.slice(0, 0), known, buckets)
    words = words.sort_by("word_id")
    word = words["word_id"].to_numpy()
    seq = _only(_seq(shard), words["id"].to_numpy())
    size = int(seq.max()) + 1
    both = np.concatenate([np.stack(unpack(x.as_buffer()), axis=1) for x in links])
    ends = np.searchsorted(word, both) + 1
    word = np.append(0, word)
    rows = []
    for text, n, left, right in phrases(_cut_between(seq, np.sort(ends[:, 0] * size + ends[:, 1])), 2, longest):
        full = np.zeros((len(n), longest + 3), np.int64)
        full[:, : text.shape[1]] = word[text]
        full[:, longest] = n
        if text.shape[1] < longest:
            full[:, longest + 1], full[:, longest + 2] = word[left], word[right]
        rows.append(full)
    return _dealt(shard["shard"][0].as_py(), np.concatenate(rows), longest, buckets)


_CANDIDATES = "ids array<long>, a long, inside boolean"


def frequent_phrases(parts: pa.Table, least: int, longest: int) -> pa.Table:
    """Of one bucket the phrases that all shards together hold ``least`` times, and whether one word always stands on a side of theirs."""
    rows, _ = _gathered(parts)
    first, group = _groups(rows[:, :longest])
    total = np.bincount(group, weights=rows[:, longest]).astype(np.int64)
    inside = np.zeros(len(first), bool)
    for c in (longest + 1, longest + 2):
        word = rows[first, c]
        inside |= (word > 0) & (np.bincount(group, weights=rows[:, c] != word[group]) == 0)
    often = total >= least
    ids = rows[first[often], :longest]
    sizes = (ids > 0).sum(1)
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(ids[ids > 0]))
    return pa.table({"ids": lists, "a": total[often], "inside": inside[often]})


def mine(docs: DataFrame, least: int = 100, first: int = 2000, longest: int = LONGEST, shard_words: int = SHARD_WORDS, bucket_words: int = BUCKET_WORDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``first`` phrases by score."""
    own = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    shards = written(own.mapInArrow(lambda batches: make_shards(batches, shard_words), _SHARD), "shards")
    totals, n_langs = counted(shards.select(F.explode("words").alias("w")).groupBy("w.lang").agg(F.sum("w.n").alias("n")), "totals")
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    totals = F.broadcast(totals) if n_langs <= BROADCAST_LANGS else totals
    buckets = max(1, -(-n_words // bucket_words))
    words = shards.select("shard", F.posexplode("words").alias("id", "w")).select("shard", (F.col("id") + 1).cast("long").alias("id"), "w.lang", "w.word", "w.n")
    # a word has one row a shard, so a window over its rows is as long as there are shards that hold it; its number is that of its first row
    w = Window.partitionBy("lang", "word")
    words = words.repartition("lang", "word").withColumn("row", F.monotonically_increasing_id() + 1)
    words = words.withColumns({"a": F.sum("n").over(w), "word_id": F.min("row").over(w)}).where(F.col("a") >= least)
    known = written(words.select("shard", "id", "word_id", *[F.when(F.col("row") == F.col("word_id"), F.col(c)).alias(c) for c in ("lang", "word", "a")]), "known-words")
    frequent = known.where("a is not null").select("word_id", "lang", "word", "a")
    known = known.select("shard", "id", "word_id")
    sequences = shards.select("shard", "seq").groupBy("shard")
    pair_parts = sequences.cogroup(known.groupBy("shard")).applyInArrow(lambda s, k: shard_pairs(s, k, buckets), _PART)
    links = written(pair_parts.groupBy("bucket").applyInArrow(lambda t: frequent_links(t, least), _LINKS), "frequent-pairs")
    either = known.unionByName(links, allowMissingColumns=True).groupBy("shard")
    parts = sequences.cogroup(either).applyInArrow(lambda s, k: shard_phrases(s, k, buckets, longest), _PART)
    candidates = written(parts.groupBy("bucket").applyInArrow(lambda t: frequent_phrases(t, least, longest), _CANDIDATES), "candidates")
    counts = frequent.select(F.array("word_id").alias("ids"), "a").unionByName(candidates.select("ids", "a"))
    left_over = _named(candidates.where(~F.col("inside")).drop("inside"), frequent)
    return _ranked(_scored(left_over.join(totals, "lang"), counts), first)


def _named(candidates: DataFrame, frequent: DataFrame) -> DataFrame:
    """Candidates with their language and their words as text."""
    flat = candidates.select("ids", "a", F.posexplode("ids").alias("at", "word_id")).join(frequent.select("word_id", "lang", "word"), "word_id")
    parts = F.array_sort(F.collect_list(F.struct("at", "word")))
    return flat.groupBy("ids", "a").agg(F.min("lang").alias("lang"), F.array_join(F.transform(parts, lambda p: p["word"]), " ").alias("phrase"))


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Candidates with the parts' counts and the score of their lowest cut."""
    cut = F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "n", "a", "ids", cut)
    cuts = cuts.withColumns({"head": F.slice("ids", F.lit(1), F.col("k")), "tail": F.slice("ids", F.col("k") + 1, F.size("ids"))}).drop("ids")
    # a part of a candidate is as frequent as it at least, so its count is known
    cuts = cuts.join(counts.select(F.col("ids").alias("head"), F.col("a").alias("l")), "head")
    cuts = cuts.join(counts.select(F.col("ids").alias("tail"), F.col("a").alias("r")), "tail")
    score = F.expr("(1000BD * cast(a AS decimal(19,0)) * cast(n AS decimal(19,0))) div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("m")
    return cuts.groupBy("lang", "phrase", "n", "a").agg(lowest).select("lang", "phrase", "a", "m.l", "m.r", "n", "m.score")


def _ranked(scored: DataFrame, first: int) -> DataFrame:
    """Each language's first rows; a language's rows are first ranked in many parts."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    parts = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    best = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= first).drop("part", "rank")
    out = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= first)
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
