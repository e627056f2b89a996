"""Exact Jaccard self-join of documents on their word shingles, with set relations used to skip work.

1. Equal sets collapse to one representative, a node; only nodes are joined.
2. Shingles are ordered by how common they are and each set's prefix goes to an inverted index. Two sets that are
   similar enough share a prefix shingle, whatever the order. Lists of a few entries give their pairs at once.
3. In longer lists, sets are compared with pivots: each component of linked sets takes, of the pivots of its lists, the
   one that its parity bitmap is closest to. The answer keeps the exact differences from the pivot. Turns with other
   pivots, then one drawn for each list, follow while they link enough.
4. What is left of the lists, sets of different components, is joined block by block. Blocks hold a bounded mean number
   of entries of one range of set sizes and prefix positions; pairs of blocks that no similar pair can come from are
   skipped whole, and a pair is formed at its first common shingle only.
5. Two sets that were compared with one pivot get their answer from those answers, exactly and without their texts:
   they differ by what one of the two differences from the pivot holds and the other doesn't. All other pairs are
   verified on the whole sets.

``join_groups`` gives components and skips pairs inside one; ``join_pairs`` gives every link. Bitmaps of the sets'
parities bound the differences of two sets from below and drop almost all pairs that aren't links.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.llm.components import components
from recspark.llm.text_units import mixed, sets_of
from recspark.sources.scratch import counted, written

#: Cells of the table of shingle counts that orders the index. It has this size whatever the input; a coarse order costs time only.
CELL_BITS = 22
_BLOCK = 1 << 14
#: Bits of a set's parity bitmap.
BITS = 512
#: Sets above this size also have a bitmap of two to four bits a shingle, as BITS fill up.
WIDE_SIZE = 1000
#: Entries up to which all pairs of a list are formed at once, and up to which a list isn't cut into cells of sizes and positions.
TINY_LIST, SHORT_LIST = 8, 500
#: Mean number of entries of a block at most.
BLOCK_ENTRIES = 256
#: Listed shingles of a set, from its first, that tell whether a pair was formed before; where two sets share none of these, a pair may be formed again.
HEAD = 32
#: Turns go on while they link this share of the pairs that they compare, and that share of what the first turn linked; what they leave is joined block by block.
LEAST_LINKED, LEAST_OF_FIRST = 0.5, 0.05
#: Keys that may be broadcast to pick their texts in place; more are joined by shuffle. A row is some 50 bytes, so 50 MB.
BROADCAST_IDS = 1_000_000

_SIGNATURE = ["n_shingles", "sig1", "sig2"]


def _signature(s: np.ndarray) -> tuple[int, int]:
    """128 bits that equal sets share."""
    a = mixed(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    b = mixed(s + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


SETS = "doc_id long, key long, n_shingles int, sig1 long, sig2 long, block int, counts binary"


def _set_rows(n: int):
    names = [x.split(" ")[0] for x in SETS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << CELL_BITS, np.uint32)
        for batch in batches:
            sizes, ones, twos = [], [], []
            for s in sets_of(batch.column("text"), n):
                np.add.at(cells, (s >> np.uint64(64 - CELL_BITS)).astype(np.int64), np.uint32(1))
                one, two = _signature(s)
                sizes.append(len(s))
                ones.append(one)
                twos.append(two)
            k = len(sizes)
            own = [pa.array(sizes, pa.int32()), pa.array(ones, pa.int64()), pa.array(twos, pa.int64())]
            yield pa.record_batch([batch.column("doc_id"), batch.column("key"), *own, pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names=names)
        blocks = cells.reshape(-1, _BLOCK)
        k = len(blocks)
        none = [pa.nulls(k, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())]
        yield pa.record_batch([*none, pa.array(range(k), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in blocks], pa.binary())], names=names)

    return run


def _block_ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, c in zip(batch.column("block").to_pylist(), batch.column("counts"), strict=True):
            c = np.frombuffer(zlib.decompress(c.as_py()), np.uint32)
            sums[k] = sums[k] + c if k in sums else c.astype(np.int64)
    ranks = [np.minimum(255, 8 * np.log2(x + 1.0)).astype(np.uint8).tobytes() for x in sums.values()]
    yield pa.record_batch([pa.array(list(sums), pa.int32()), pa.array(ranks, pa.binary())], names=["block", "ranks"])


def _ranks(cells: DataFrame) -> np.ndarray:
    """How common each cell's shingles are, in eighth steps of the logarithm: a byte a cell, in the order of cells."""
    n = (1 << CELL_BITS) // _BLOCK
    found = cells.repartition(n, "block").mapInArrow(_block_ranks, "block int, ranks binary").collect()  # 2**CELL_BITS bytes
    return np.frombuffer(b"".join(bytes(r["ranks"]) for r in sorted(found, key=lambda r: r["block"])), np.uint8)


def _prefix_length(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def _parities(s: np.ndarray, bits: int) -> np.ndarray:
    """Whether an odd number of the set's shingles falls on each of ``bits`` places, a power of two, in 64-bit words."""
    odd = np.bincount((mixed(s) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


PREFIXES = "key long, sig1 long, sig2 long, size int, prefix array<long>, bits array<long>, wide array<long>"


def _prefix_rows(n: int, percent: int, least: int, ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks.value
        for batch in batches:
            rows = []
            for key, s in zip(batch.column("key").to_pylist(), sets_of(batch.column("text"), n), strict=True):
                if len(s) < least:
                    continue
                rank = table[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)].astype(np.uint64)
                order = np.argsort((rank << np.uint64(56)) | (s >> np.uint64(8)), kind="stable")
                prefix = s[order[: _prefix_length(len(s), percent)]].view(np.int64)
                wide = _parities(s, 2 << int(len(s)).bit_length()) if len(s) > WIDE_SIZE else None
                rows.append((key, *_signature(s), len(s), prefix, _parities(s, BITS), wide))
            longs = pa.list_(pa.int64())
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), longs, longs, longs]
            cols = list(zip(*rows, strict=True)) or [[] for _ in types]
            yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=[x.split(" ")[0] for x in PREFIXES.split(", ")])

    return run


# ---- pairs to answers


def _needed_sets(n: int):
    """Batches of (node, sig1, sig2, text) to (node, shingles) of the rows whose set has that signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, found = [], []
            wanted = zip(*(batch.column(c).to_pylist() for c in ("node", "sig1", "sig2")), strict=True)
            for (node, *sig), s in zip(wanted, sets_of(batch.column("text"), n), strict=True):
                if tuple(sig) == _signature(s):
                    nodes.append(node)
                    found.append(s.tobytes())
            yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(found, pa.binary())], names=["node", "shingles"])

    return run


ANSWERS = "a long, b long, common int, size_a int, size_b int, differences array<long>"


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (a, b, set_a, set_b), in runs of one ``a``, to ANSWERS; the differences are null where the sets are far apart."""
    last, x = None, np.zeros(0, np.uint64)
    for batch in batches:
        rows = []
        heads, set_a, set_b = batch.column("a").to_pylist(), batch.column("set_a"), batch.column("set_b")
        for i, b in enumerate(batch.column("b").to_pylist()):
            if heads[i] != last:
                last, x = heads[i], np.frombuffer(set_a[i].as_py(), np.uint64)
            y = np.frombuffer(set_b[i].as_py(), np.uint64)
            differences = np.setxor1d(x, y, assume_unique=True)
            near = 4 * len(differences) <= len(x) + len(y)
            rows.append((last, b, (len(x) + len(y) - len(differences)) // 2, len(x), len(y), differences.view(np.int64) if near else None))
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
        cols = list(zip(*rows, strict=True)) or [[] for _ in types]
        yield pa.record_batch([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=[x.split(" ")[0] for x in ANSWERS.split(", ")])


def _linked(percent: int) -> Column:
    return 100 * F.col("common").cast("long") >= percent * (F.col("size_a") + F.col("size_b") - F.col("common")).cast("long")


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b).cast("long") >= percent * F.greatest(a, b).cast("long")


def _room(size_a: Column, pos_a: Column, size_b: Column, pos_b: Column, percent: int) -> Column:
    """Whether sets whose first common shingle is at these positions can be similar: that one and what follows must make up the overlap."""
    most = 1 + F.least(size_a - pos_a - 1, size_b - pos_b - 1).cast("long")
    return (100 + percent) * most >= percent * (size_a + size_b).cast("long")


def _differ(bits_a: Column, bits_b: Column) -> Column:
    """Bits in which two parity bitmaps differ: at most the number of shingles that one set has and the other has not."""
    return sum((F.bit_count(F.get(bits_a, F.lit(i)).bitwiseXOR(F.get(bits_b, F.lit(i)))) for i in range(BITS // 64)), F.lit(0))


def _few_enough(differ: Column, size_a: Column, size_b: Column, percent: int) -> Column:
    return differ.cast("long") * (100 + percent) <= (size_a + size_b).cast("long") * (100 - percent)


def _fitting(pairs: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose bitmaps allow a link."""
    for side in "ab":
        own = bits.select(F.col("node").alias(side), F.col("size").alias(f"size_{side}"), F.col("bits").alias(f"bits_{side}"))
        pairs = pairs.join(own, side)
    differ = _differ(F.col("bits_a"), F.col("bits_b"))
    return pairs.where(_few_enough(differ, F.col("size_a"), F.col("size_b"), percent)).select("a", "b")


def _fitting_wide(pairs: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, …), those of smaller sets and those of larger ones whose wide bitmaps allow a link.

    Of two lengths the longer is folded, which keeps parities.
    """
    names = pairs.columns
    for side in "ab":
        own = wide.select(F.col("node").alias(side), F.col("size").alias(f"size_{side}"), F.col("wide").alias(f"wide_{side}"))
        pairs = pairs.join(own, side, "left")
    x, y = F.col("wide_a"), F.col("wide_b")
    n = F.least(F.size(x), F.size(y))

    def folded(bits: Column, i: Column) -> Column:
        return F.get(bits, i).bitwiseXOR(F.coalesce(F.get(bits, i + n), F.lit(0).cast("long")))

    differ = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda s, i: s + F.bit_count(folded(x, i).bitwiseXOR(folded(y, i))).cast("int"))
    fits = F.when(x.isNotNull() & y.isNotNull(), _few_enough(differ, F.col("size_a"), F.col("size_b"), percent)).otherwise(F.lit(True))
    return pairs.where(fits).select(*names)


@dataclass(frozen=True)
class _Index:
    """What the joins start from: sets of all rows, a node for each class of equal sets, bitmaps, and the lists of the nodes' prefixes."""

    docs: DataFrame
    sets: DataFrame
    nodes: DataFrame
    bits: DataFrame
    wide: DataFrame
    entries: DataFrame
    n: int
    percent: int

    def tiny_pairs(self) -> DataFrame:
        """(a, b), a < b: all pairs of short lists that may be similar."""
        left, right = (self.entries.where(F.col("n") <= TINY_LIST).select("token", *[F.col(c).alias(f"{k}_{c}") for c in ("node", "size", "pos")]) for k in "xy")
        fit = _sizes_fit(F.col("x_size"), F.col("y_size"), self.percent) & _room(F.col("x_size"), F.col("x_pos"), F.col("y_size"), F.col("y_pos"), self.percent)
        few = left.join(right, "token").where((F.col("x_node") < F.col("y_node")) & fit).select(F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct()
        return _fitting(few, self.bits, self.percent)

    def long_lists(self) -> DataFrame:
        """The entries of the other lists, with their bitmaps."""
        return written(self.entries.where(F.col("n") > TINY_LIST).join(self.bits.select("node", "bits"), "node"), "lists")

    def compared(self, pairs: DataFrame) -> DataFrame:
        """ANSWERS for the pairs (a, b) whose wide bitmaps allow a link, from the whole texts; pairs are expected to be distinct."""
        pairs = written(_fitting_wide(pairs.select("a", "b"), self.wide, self.percent), "pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node"))
        needed, k = counted(self.nodes.select("node", "key", "sig1", "sig2").join(ends, "node", "left_semi"), "needed")
        needed = F.broadcast(needed) if k <= BROADCAST_IDS else needed
        texts = self.docs.select("key", "text").join(needed, "key").select("node", "sig1", "sig2", "text")
        sets = written(texts.mapInArrow(_needed_sets(self.n), "node long, shingles binary").dropDuplicates(["node"]), "shingles")
        left, right = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}")) for c in "ab")
        both = pairs.join(right, "b").join(left, "a").select("a", "b", "set_a", "set_b")
        return both.sortWithinPartitions("a").mapInArrow(_compared, ANSWERS)


def _indexed(docs: DataFrame, n: int, percent: int) -> _Index:
    spark = docs.sparkSession
    # the key tells rows apart by id and text, so that ids may be null or repeat
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.col("doc_id").cast("long"), "text").alias("key"))
    found = written(docs.mapInArrow(_set_rows(n), SETS), "sets")
    sets = found.where("block is null").select("doc_id", "key", *_SIGNATURE)
    nodes = sets.where("n_shingles > 0").groupBy(*_SIGNATURE).agg(F.min("doc_id").alias("least"), F.min("key").alias("key"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    ranks = spark.sparkContext.broadcast(_ranks(found.where("block is not null").select("block", "counts")))
    # below this size a set has no similar set but itself
    least = -(-percent // (100 - percent)) if percent < 100 else 2**31 - 1
    prefixes = docs.select("key", "text").mapInArrow(_prefix_rows(n, percent, least, ranks), PREFIXES)
    mine = ["key", "sig1", "sig2"]
    prefixes = prefixes.join(nodes.select(*mine, "node"), mine).dropDuplicates(mine).drop(*mine)
    prefixes = written(prefixes, "prefixes")
    postings = prefixes.select("node", "size", F.posexplode("prefix").alias("pos", "token"))
    lists = postings.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    entries = written(postings.join(lists, "token"), "entries")
    bits, wide = prefixes.select("node", "size", "bits"), prefixes.where("wide is not null").select("node", "size", "wide")
    return _Index(docs, sets, nodes, bits, wide, entries, n, percent)


# ---- pivots and blocks


def _by_piece(lists: DataFrame, per_list: DataFrame, how: str) -> DataFrame:
    """``lists`` joined with one row a list (token, n, …); long lists are joined piece by piece, so that no task reads one in whole."""
    pieces = F.ceil(F.col("n") / BLOCK_ENTRIES)
    right = per_list.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))).drop("n")
    return lists.withColumn("piece", F.pmod(F.xxhash64("node"), pieces)).join(right, ["token", "piece"], how).drop("piece")


def _pivot_pairs(lists: DataFrame, percent: int, turn: int) -> DataFrame:
    """A pair (pivot a, set b) for each component at most: of the pivots of its sets' lists, the closest by bitmaps, if they can be similar.

    ``lists``: token, node, size, component, bits. In the first turn lists share their pivots, the sets with the smallest hash, so that many sets
    have answers from one pivot. Later each list draws a pivot of its own, so that a set which the shared one missed meets as many others as it has lists.
    """
    drawn = F.xxhash64("node", "token", F.lit(turn)) if turn else F.xxhash64("node", F.lit(turn))
    own = F.struct(drawn.alias("h"), F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("component").alias("ca"), F.col("bits").alias("bits_a"))
    pivots = lists.groupBy("token").agg(F.max("n").alias("n"), F.min(own).alias("p")).select("token", "n", "p.a", "p.size_a", "p.ca", "p.bits_a")
    differ = _differ(F.col("bits"), F.col("bits_a"))
    may = (F.col("component") != F.col("ca")) & _sizes_fit(F.col("size"), F.col("size_a"), percent) & _few_enough(differ, F.col("size"), F.col("size_a"), percent)
    met = _by_piece(lists, pivots, "inner").where(may)
    closest = F.min(F.struct((differ / (F.col("size") + F.col("size_a"))).alias("d"), F.xxhash64("a").alias("h"), "a", F.col("node").alias("b")))
    return met.groupBy("component").agg(closest.alias("p")).select("p.a", "p.b")


def _with_components(lists: DataFrame, labels: DataFrame | None) -> DataFrame:
    if labels is None:
        return lists.withColumn("component", F.col("node"))
    return lists.join(labels.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))


def _blocked_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b, ca, cb, differ): pairs of entries of one list that lie in different components and may be similar.

    A block is a list's entries of one cell, set sizes within a quarter of the allowed ratio and positions within a power
    of two, cut by hash into pieces of BLOCK_ENTRIES on average; a short list is one cell. Blocks meet only if a similar
    pair can come from them and they hold more than one component.
    """
    c = F.col
    split = lists.groupBy("token").agg(F.max("n").alias("n"), F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1").select("token", "n")
    lists = _by_piece(lists, split, "left_semi")
    heads = lists.groupBy("node").agg(F.slice(F.array_sort(F.collect_list(F.struct("pos", "token"))), 1, HEAD).alias("head"))
    lists = lists.join(heads, "node").withColumn("before", F.transform(F.filter("head", lambda x: x["pos"] < c("pos")), lambda x: x["token"])).drop("head")
    grain = np.log(100 / percent) / 4
    cell = F.when(c("n") > SHORT_LIST, F.xxhash64(F.floor(F.log(c("size").cast("double")) / F.lit(float(grain))), F.floor(F.log2(c("pos") + 1.0)))).otherwise(F.lit(0).cast("long"))
    piece = F.pmod(F.xxhash64("node"), F.ceil(c("n") / BLOCK_ENTRIES))
    lists = written(lists.withColumn("block", F.xxhash64(cell, piece)), "blocks")
    blocks = lists.groupBy("token", "block").agg(
        F.min("size").alias("s0"), F.max("size").alias("s1"), F.min("pos").alias("p0"), F.min("component").alias("c0"), F.max("component").alias("c1")
    )
    meet = (
        (c("x.token") == c("y.token"))
        & (c("x.block") <= c("y.block"))
        & ~((c("x.c0") == c("x.c1")) & (c("y.c0") == c("y.c1")) & (c("x.c0") == c("y.c0")))
        & (100 * c("x.s1").cast("long") >= percent * c("y.s0").cast("long"))
        & (100 * c("y.s1").cast("long") >= percent * c("x.s0").cast("long"))
        # the largest sets at the smallest positions have the most room; the smallest sets need the least overlap
        & ((100 + percent) * F.least(c("x.s1") - c("x.p0"), c("y.s1") - c("y.p0")).cast("long") >= percent * (c("x.s0") + c("y.s0")).cast("long"))
    )
    met = blocks.alias("x").join(blocks.alias("y"), meet).select(c("x.token").alias("token"), c("x.block").alias("xb"), c("y.block").alias("yb"))
    names = ("node", "size", "pos", "component", "bits", "before")
    left, right = (met.join(lists.select("token", c("block").alias(f"{k}b"), *[c(x).alias(f"{k}_{x}") for x in names]), ["token", f"{k}b"]) for k in "xy")
    differ = _differ(c("x_bits"), c("y_bits"))
    may = (
        ((c("xb") != c("yb")) | (c("x_node") < c("y_node")))
        & (c("x_component") != c("y_component"))
        & _sizes_fit(c("x_size"), c("y_size"), percent)
        & _room(c("x_size"), c("x_pos"), c("y_size"), c("y_pos"), percent)
        & _few_enough(differ, c("x_size"), c("y_size"), percent)
        # a shingle that both have before this one has formed the pair
        & ~F.arrays_overlap("x_before", "y_before")
    )
    both = left.join(right, ["token", "xb", "yb"]).where(may)
    sides = [f(f"x_{x}", f"y_{x}").alias(k) for f, x, k in ((F.least, "node", "a"), (F.greatest, "node", "b"), (F.least, "component", "ca"), (F.greatest, "component", "cb"))]
    return both.select(*sides, differ.alias("differ")).distinct()


def _near(answers: DataFrame) -> DataFrame:
    """(node, pivot, size, differences) of sets whose differences from a pivot are known; a pivot has none from itself."""
    known = answers.where("differences is not null")
    own = known.select(F.col("b").alias("node"), F.col("a").alias("pivot"), F.col("size_b").alias("size"), "differences")
    none = F.array().cast("array<long>")
    return own.unionByName(known.select(F.col("a").alias("node"), F.col("a").alias("pivot"), F.col("size_a").alias("size"), none.alias("differences")).distinct())


def _derived(pairs: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) of the pairs whose sets were compared with one pivot, from those answers."""
    for side in "ab":
        own = near.select(F.col("node").alias(side), "pivot", F.col("size").alias(f"size_{side}"), F.col("differences").alias(f"from_{side}"))
        pairs = pairs.join(own, [side] if side == "a" else [side, "pivot"])
    apart = F.size("from_a") + F.size("from_b") - 2 * F.size(F.array_intersect("from_a", "from_b"))
    answers = pairs.withColumn("common", F.floor((F.col("size_a") + F.col("size_b") - apart) / 2)).select("a", "b", _linked(percent).alias("linked"))
    return answers.distinct()


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``labels`` (node, component) with the links (a, b) taken in. Only the components that the links join are looked at."""
    if labels is None:
        return written(components(links), "labels")
    for side in "ab":
        links = links.join(labels.select(F.col("node").alias(side), F.col("component").alias(f"c{side}")), side, "left").withColumn(side, F.coalesce(f"c{side}", side)).drop(f"c{side}")
    joined = written(components(links.where("a <> b")), "joined")
    old = labels.join(joined.select(F.col("node").alias("component"), F.col("component").alias("now")), "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    return written(old.unionByName(joined.join(labels, "node", "left_anti")), "labels")


def join_groups(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text; other columns are not used).

    Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z is lower-cased. A document's set holds its distinct ``n``-word
    shingles; with fewer words, the whole sequence. Two rows link when 100 * intersection >= percent * union;
    component_id is the smallest doc_id reachable by links. A text that is null or has no word has an empty set, links
    with nothing and keeps its own id. Each row is judged by its own text, also where ids repeat; a null doc_id is
    returned with the component of its set, null if no row there has an id. Very long texts are compared in whole; an
    empty table gives no rows.
    """
    index = _indexed(docs, n, percent)
    lists, labels, answers, turn, most = index.long_lists(), None, [], 0, 0
    while True:
        pairs = _pivot_pairs(_with_components(lists, labels), percent, turn)
        if turn == 0:
            pairs = pairs.unionByName(index.tiny_pairs())
        found = index.compared(pairs)
        found, k = counted(found.withColumn("linked", _linked(percent)), "answers")
        links, n_links = counted(found.where("linked").select("a", "b"), "links")
        answers.append(found)
        if n_links:
            labels = _merged(labels, links)
        turn, most = turn + 1, max(most, n_links)
        if n_links < max(1, LEAST_LINKED * k, LEAST_OF_FIRST * most):
            break
    likely, k = counted(_blocked_pairs(_with_components(lists, labels), percent), "likely")
    if k:
        known = answers[0].limit(0)
        for found in answers:
            known = known.unionByName(found)
        likely = likely.join(known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), ["a", "b"], "left_anti")
        derived = written(_derived(likely.select("a", "b"), _near(known), percent), "derived")
        open_ = written(likely.join(derived, ["a", "b"], "left_anti"), "open")
        # of the pairs between two components the likeliest is compared first, and the others only if that is no link
        first = open_.groupBy("ca", "cb").agg(F.min(F.struct("differ", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
        met = written(index.compared(first), "answers")
        labels = _merged(labels, derived.where("linked").select("a", "b").unionByName(met.where(_linked(percent)).select("a", "b")))
        side = {c: labels.select(F.col("node").alias(c), F.col("component").alias(f"now_{c}")) for c in "ab"}
        others = open_.join(side["a"], "a", "left").join(side["b"], "b", "left").where(F.coalesce("now_a", "a") != F.coalesce("now_b", "b")).select("a", "b")
        others, k = counted(others.join(met.select("a", "b"), ["a", "b"], "left_anti"), "others")
        if k:
            labels = _merged(labels, written(index.compared(others).where(_linked(percent)).select("a", "b"), "links"))

    named = index.nodes.select("node", "least", *_SIGNATURE)
    named = named.withColumn("component", F.col("node")) if labels is None else named.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = written(named, "named")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    classes = named.join(smallest, "component").select(*_SIGNATURE, "component_id")
    out = index.sets.alias("s").join(classes.alias("c"), [F.col(f"s.{c}") == F.col(f"c.{c}") for c in _SIGNATURE], "left")
    own = F.when(F.col("s.n_shingles") > 0, F.col("c.component_id")).otherwise(F.col("s.doc_id"))
    return out.select("s.doc_id", F.col("s.n_shingles").cast("long").alias("n_shingles"), own.alias("component_id"))


def join_pairs(docs: DataFrame, n: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """All links: pairs (a, b), a < b, of nodes that link, and members (doc_id, node, component_id) of every row of ``docs``.

    Rows of equal sets share a node, a number of this call, and link with each other and with what links to it; node is
    null for a row without words. component_id is the smallest doc_id of the node's rows. Sets and links are those of
    ``join_groups``. Each set is compared with a pivot; pairs of sets that have a pivot in common are decided by their
    differences from it, all others are compared. Work grows with the number of links.
    """
    index = _indexed(docs, n, percent)
    lists = index.long_lists().withColumn("component", F.col("node"))
    pivots = written(_pivot_pairs(lists, percent, 0), "pivots")
    met = written(index.compared(pivots), "answers")
    known = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    likely = index.tiny_pairs().unionByName(_blocked_pairs(lists, percent).select("a", "b")).distinct()
    likely = written(likely.join(known, ["a", "b"], "left_anti"), "likely")
    derived = written(_derived(likely, _near(met), percent), "derived")
    others = index.compared(likely.join(derived, ["a", "b"], "left_anti"))
    pairs = derived.where("linked").select("a", "b")
    for found in (met, others):
        pairs = pairs.unionByName(found.where(_linked(percent)).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    members = index.sets.join(index.nodes.select(*_SIGNATURE, "node", F.col("least").alias("component_id")), _SIGNATURE, "left").select("doc_id", "node", "component_id")
    return pairs.distinct(), members
