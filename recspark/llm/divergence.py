"""Source divergence audit: how far the word shares of a language's sources lie apart, and which words make the difference.

1. Tasks count terms with Arrow: texts are lowered by ``ascii_lower``, split by ``split_pattern_regex``, ``dictionary_encode``d, and
   counted by hash ``group_by`` for (lang, source, term). A worker merges its own partial counts before it hands them on.
2. One shuffle by (lang, term) merges them to a row a term with its documents and its counts by source. Terms in fewer than
   ``min_docs`` documents of the language go. The rest is written: the columnar shards.
3. Each language's terms are dealt to chunks by hash. A chunk meets the totals of the language's sources in a cogroup, and gives the
   part of each pair's divergence that its terms make and each source's foremost terms; parts are summed, foremost terms ranked.

Where a term is absent from two sources, its summand is one number a pair, so work follows the counts that exist times the sources.

Null text, lang and source count as empty. A language without kept terms has pairs of value 0 and no term rows. Repeated rows count
each; equal values are ordered by the item's UTF-8 bytes. Other columns are ignored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.llm.arrow_terms import batch_slices, split_terms
from recspark.sources.scratch import counted, written

#: What stands between terms: ASCII characters other than letters.
STOPS = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Shares are whole numbers of this unit.
UNIT = 1_000_000_000
#: Partial counts that a worker merges at once.
HELD_ROWS = 1_000_000
#: Terms that a chunk holds on average, and numbers of one dense block in it.
CHUNK_TERMS, BLOCK_CELLS = 20_000, 1 << 22

_PARTIAL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
_NAMES = ["lang", "source", "term"]


def _slice_counts(b: pa.RecordBatch) -> pa.Table:
    """The counts of one slice of rows, its strings as dictionaries."""
    terms, rows = split_terms(pc.ascii_lower(b.column("text")), STOPS)
    term = terms.dictionary_encode()
    per_doc = pa.table({"term": term.indices, "row": rows}).group_by(["term", "row"], use_threads=False).aggregate([([], "count_all")])
    row = per_doc["row"].combine_chunks()
    lang, source = (b.column(c).dictionary_encode() for c in ("lang", "source"))
    keys = pa.table({"lang": lang.indices.take(row), "source": source.indices.take(row), "term": per_doc["term"], "n": per_doc["count_all"]})
    got = keys.group_by(_NAMES, use_threads=False).aggregate([("n", "sum"), ([], "count_all")])
    return _as_strings(got.rename_columns([*_NAMES, "n", "docs"]), {"lang": lang.dictionary, "source": source.dictionary, "term": term.dictionary})


def _as_strings(t: pa.Table, words: dict[str, pa.Array]) -> pa.Table:
    own = {c: pa.DictionaryArray.from_arrays(t[c].combine_chunks(), w) for c, w in words.items()}
    return pa.table({**own, "n": t["n"], "docs": t["docs"]})


def _merged(held: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(held).unify_dictionaries().combine_chunks()
    coded = {c: t[c].chunk(0) for c in _NAMES}
    keys = pa.table({**{c: a.indices for c, a in coded.items()}, "n": t["n"], "docs": t["docs"]})
    got = keys.group_by(_NAMES, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")]).rename_columns([*_NAMES, "n", "docs"])
    return _as_strings(got, {c: a.dictionary for c, a in coded.items()})


def partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a task's rows, a key once as long as HELD_ROWS hold them."""
    held: list[pa.Table] = []
    rows = 0
    for big in batches:
        for b in batch_slices(big, "text"):
            t = _slice_counts(b)
            if not len(t):
                continue
            held.append(t)
            rows += len(t)
            if rows > HELD_ROWS:
                one = _merged(held)
                held, rows = [one], len(one)
                if rows > HELD_ROWS // 2:
                    yield from one.cast(_PARTIAL).to_batches(max_chunksize=65536)
                    held, rows = [], 0
    if held:
        yield from _merged(held).cast(_PARTIAL).to_batches(max_chunksize=65536)


def term_shards(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, term, counts array<struct<source, n>>): the terms in at least ``min_docs`` documents of the language."""
    partial = docs.mapInArrow(partial_counts, "lang string, source string, term string, n long, docs long")
    # dealt by (lang, term), both groupings below need no other shuffle
    sums = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = sums.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("counts"), F.sum("docs").alias("docs"))
    return terms.where(F.col("docs") >= min_docs).drop("docs")


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (count + 2) / total), by long division, so that products stay in 64 bits up to 9 * 10^15 counts."""
    out, rest = np.divmod(counts.astype(np.int64) + 2, totals)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, totals)
        out = out * 1000 + more
    return out + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def _chunk_parts(key, terms: pa.Table, groups: pa.Table, top: int) -> pa.Table:
    """The parts of one chunk of a language's terms: a row for each pair of sources, and ``top`` terms at most for each source."""
    lang = key[0].as_py()
    groups = groups.sort_by("source")
    sources, totals = groups["source"].to_pylist(), groups["total"].to_numpy()
    n_sources = len(sources)
    terms = terms.sort_by("term")
    flat = terms["counts"].combine_chunks()
    row = pc.list_parent_indices(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = pc.list_flatten(flat)
    name, n = entries.field("source"), entries.field("n").to_numpy(zero_copy_only=False)
    at = pc.index_in(name, value_set=groups["source"].combine_chunks()).to_numpy(zero_copy_only=False).astype(np.int64)
    out = {"source": [], "part": [], "item": [], "value": []}

    def add(source, part, item, value):
        for column, got in zip(out.values(), (source, part, item, value), strict=True):
            column.append(got)

    pairs = np.zeros((n_sources, n_sources), np.int64)
    if len(terms):
        p = shares(n, totals[at])
        absent = shares(np.zeros(n_sources, np.int64), totals)
        in_lang = np.add.reduceat(n, np.searchsorted(row, np.arange(len(terms))))
        q = shares(in_lang, groups["lang_total"].to_numpy()[:1])[row]
        value = np.where(p > q, gap(p, q), -1)
        order = np.lexsort((row, -value, at))  # rows are in the order of the terms' bytes
        order = order[value[order] >= 0]
        starts = np.searchsorted(at[order], np.arange(n_sources))
        first = order[np.arange(len(order)) - starts[at[order]] < top]
        words = terms["term"].combine_chunks().take(pa.array(row[first])).to_pylist()
        for i, w in zip(first.tolist(), words, strict=True):
            add(sources[at[i]], "term", w, int(value[i]))
        pairs = _pair_sums(row, at, p, absent, len(terms))
    for a in range(n_sources):
        for b in range(n_sources):
            if a != b:
                add(sources[a], "pair", sources[b], int(pairs[a, b]))
    return pa.table({"lang": pa.array([lang] * len(out["item"]), pa.string()), **{c: pa.array(v, pa.int64() if c == "value" else pa.string()) for c, v in out.items()}})


def _pair_sums(row: np.ndarray, at: np.ndarray, p: np.ndarray, absent: np.ndarray, n_terms: int) -> np.ndarray:
    """For each two sources the sum of the gaps of all ``n_terms`` terms; ``row``, ``at``, ``p`` are the counts that exist, by term."""
    n_sources = len(absent)
    single, both = np.zeros((n_sources, n_sources), np.int64), np.zeros((n_sources, n_sources), np.int64)
    one_side = np.zeros((n_sources, n_sources), np.int64)
    step = max(1, BLOCK_CELLS // n_sources)
    for first in range(0, n_terms, step):
        a, b = np.searchsorted(row, [first, first + step])
        r, c = row[a:b] - first, at[a:b]
        dense = np.tile(absent, (min(step, n_terms - first), 1))
        dense[r, c] = p[a:b]
        here = np.zeros(dense.shape, bool)
        here[r, c] = True
        for s in range(n_sources):
            mine = np.flatnonzero(here[:, s])
            if not len(mine):
                continue
            values, there = gap(dense[mine, s][:, None], dense[mine]), here[mine]
            both[s] += np.where(there, values, 0).sum(0)
            single[s] += np.where(there, 0, values).sum(0)
            one_side[s] += there.sum(0)
    # terms of s or t: those of s, those of t, less those of both
    own = np.diag(one_side)
    neither = n_terms - own[:, None] - own[None, :] + one_side
    return both + single + single.T + neither * gap(absent[:, None], absent[None, :])


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10) -> DataFrame:
    """(lang, source, part, item, value, rank) of documents with text, lang and source.

    Part ``pair``: item is each other source of the language, value the summed gap between the two sources' shares. Part ``term``:
    item is a term that the source uses more than its language does, value its gap, the ``top`` largest.
    """
    own = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    kept, n_terms = counted(term_shards(own, min_docs), "terms")
    totals = kept.select("lang", F.explode("counts").alias("c")).groupBy("lang", F.col("c.source").alias("source")).agg(F.sum("c.n").alias("n"))
    vocabulary = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda s, c: s + c["n"])).alias("lang_n"))
    groups = own.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(vocabulary, "lang", "left")
    twice = 2 * F.coalesce("v", F.lit(0))
    groups = groups.select("lang", "source", (F.coalesce("n", F.lit(0)) + twice).alias("total"), (F.coalesce("lang_n", F.lit(0)) + twice).alias("lang_total"))
    chunks = max(1, -(-n_terms // CHUNK_TERMS))
    dealt = kept.select("lang", F.pmod(F.xxhash64("term"), F.lit(chunks)).alias("chunk"), "term", "counts")
    everywhere = written(groups, "groups").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))

    def parts(key, a, b):
        return _chunk_parts(key, a, b, top)

    made = dealt.groupBy("lang", "chunk").cogroup(everywhere.groupBy("lang", "chunk")).applyInArrow(parts, "lang string, source string, part string, item string, value long")
    # a term lies in one chunk, so only pairs are sums
    summed = made.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    return summed.withColumn("rank", rank).where((F.col("part") == "pair") | (F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")
