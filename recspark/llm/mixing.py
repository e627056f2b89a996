"""Mixing sources to target weights by pivotal dependent rounding.

Each document is to be copied a fractional number of times, its source's target over its source's size. Rounding pairs
two fractional documents of a source and moves mass between them, at random and without changing the expected copies
or the pair's total size, until one of them is whole. Groups of a bounded mean number of documents are rounded side by
side, each leaves at most one fractional document, and those are rounded again level by level: a reduction tree whose
root is one document a source. Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions.names import fresh
from recspark.sources.scratch import counted, written

WORD = r"[^\x20\x09-\x0D]+"

#: Mean number of documents that one group of a level rounds.
FAN_IN = 48


def n_words(text: Column) -> Column:
    """Number of words ``[^\\x20\\x09-\\x0D]+``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size, n_docs, target) from rows of (source, size).

    Sources in code point order, null last, take the weights in turn and share ``share`` times all sizes. A target
    stops at ``most`` times its source's size; the excess goes to the others by weight until none is above, which is
    one level ``f``: target = min(most * size, f * weight). Sizes of zero give targets of zero. The windows run over
    one row a source, after the aggregation.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    fills = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    below = F.coalesce(F.sum("cap").over(fills.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(fills.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (F.lit(float(share)) * F.sum("source_size").over(everything) - below) / rest)
    # the first source whose cap isn't reached sets the level of all that follow
    per = per.withColumn("f", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)["level"])
    target = F.when(F.col("f").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("f") * F.col("weight")))
    return per.select("source", "source_size", "n_docs", target.alias("target"))


def _unit(*parts: Column) -> Column:
    """A number in (0, 1) that the parts decide."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + F.lit(0.5)) * F.lit(2.0**-53)


def _round_group(items: Column, seed: int) -> Column:
    """Fold of one group's sorted array of struct(key, size, p): struct(left: the fractional one or null, done: struct(key, up) array)."""
    entry, one = "struct<key:bigint,size:bigint,p:double>", "array<struct<key:bigint,up:boolean>>"

    def settled(e: Column, up: Column) -> Column:
        return F.struct(e["key"].alias("key"), up.alias("up"))

    def step(state: Column, e: Column) -> Column:
        a, b = state["left"], e
        total = a["size"] * a["p"] + b["size"] * b["p"]
        # how far a can rise while b falls, and the reverse, in mass; the pair's mass stays
        rise = F.least(a["size"] * (1 - a["p"]), b["size"] * b["p"])
        fall = F.least(a["size"] * a["p"], b["size"] * (1 - b["p"]))
        up = _unit(F.lit(seed), a["key"], b["key"]) * (rise + fall) < fall
        mass = F.when(up, a["size"] * a["p"] + rise).otherwise(a["size"] * a["p"] - fall)
        pa, pb = mass / a["size"], F.greatest(F.lit(0.0), total - mass) / b["size"]
        whole_a = F.when(up, a["size"] * (1 - a["p"]) <= b["size"] * b["p"]).otherwise(a["size"] * a["p"] <= b["size"] * (1 - b["p"]))
        kept = F.when(whole_a, F.struct(b["key"].alias("key"), b["size"].alias("size"), pb.alias("p"))).otherwise(F.struct(a["key"].alias("key"), a["size"].alias("size"), pa.alias("p")))
        # a is whole at 1 if it rose, b at 0; the reverse if a fell
        out = F.when(whole_a, settled(a, up)).otherwise(settled(b, ~up))
        nxt = F.struct(kept.cast(entry).alias("left"), F.concat(state["done"], F.array(out)).cast(one).alias("done"))
        first = F.struct(b.cast(entry).alias("left"), state["done"].alias("done"))
        return F.when(a.isNull(), first).otherwise(nxt)

    start = F.struct(F.lit(None).cast(entry).alias("left"), F.array().cast(one).alias("done"))
    return F.aggregate(items, start, step)


def pivotal_round(parts: DataFrame, seed: int = 7) -> DataFrame:
    """(key, up) for rows of (key, source, size > 0, p): up with probability p, each source's sum of size * p kept to within one row's size.

    Keys are distinct longs. A level groups a source's rows by hash, FAN_IN a group on average, so a hot source has as
    many more groups; each group is folded in one row and passes on at most one fractional row. Levels end when no
    source has more than one, which goes to the nearer whole number. p of 0 or 1 stays as it is.
    """
    here, level, done = written(parts.select("key", "source", "size", "p"), "pivotal"), 0, []
    while True:
        counts = here.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            break
        groups = counts.select("source", F.ceil(F.col("n") / FAN_IN).alias("groups"))
        s = here.alias("s").join(groups.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source")))
        dealt = s.select("s.*", F.pmod(F.xxhash64(F.lit(seed + level), "key"), F.col("groups")).alias("slot"))
        item = F.struct("key", F.col("size"), F.col("p"))
        order = F.sort_array(F.collect_list(F.struct(F.xxhash64(F.lit(seed), "key").alias("o"), item.alias("v"))))
        folded = dealt.groupBy("source", "slot").agg(order.alias("items"))
        folded = folded.select("source", _round_group(F.transform("items", lambda x: x["v"]), seed + 1000 * level).alias("r"))
        folded = written(folded.select("source", F.col("r.left").alias("left"), F.col("r.done").alias("done")), "pivotal")
        done.append(folded.select(F.inline("done")))
        here = folded.where("left is not null").select("left.key", "source", "left.size", "left.p")
        level += 1
    last = here.select("key", (F.col("p") >= 0.5).alias("up"))
    for d in done:
        last = last.unionByName(d)
    return last


def narrow_rows(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size, crc): what the mix needs of each document; the text goes no further."""
    return documents.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("crc"))


def plan_copies(narrow: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """(doc_id, source, size, crc, times, source_size, target, copies, more) for each distinct row of ``narrow``.

    ``times`` counts its repetitions; each is taken ``copies`` times, and ``more`` of them once more. Expected copies are
    target / source_size of the source; a document of size 0 gets the whole part of that. Of equal rows the whole part
    of their extra copies is given out at once, and only what is left over is rounded. The same rows give the same
    result at every run.
    """
    distinct = written(narrow.groupBy("doc_id", "source", "size", "crc").agg(F.count(F.lit(1)).alias("times")), "sizes")
    targets = source_targets(distinct.select("source", (F.col("size") * F.col("times")).alias("size")), weights, share, most)
    ratio = F.when(F.col("t.source_size") > 0, F.col("t.target") / F.col("t.source_size")).otherwise(F.lit(0.0))
    j = distinct.alias("n").join(targets.alias("t"), F.col("n.source").eqNullSafe(F.col("t.source")))
    j = j.select("n.*", "t.source_size", "t.target", ratio.alias("ratio"), F.xxhash64("n.doc_id", "n.source", "n.size", "n.crc").alias("key"))
    extra = F.when(F.col("size") > 0, (F.col("ratio") - F.floor("ratio")) * F.col("times")).otherwise(F.lit(0.0))
    j = written(j.withColumn("extra", extra).withColumn("p", F.col("extra") - F.floor("extra")), "ratios")
    # rows whose keys collide share a decision; grouping keeps keys distinct
    fractional = j.where("p > 0").groupBy("key").agg(F.min("source").alias("source"), F.sum("size").alias("size"), F.min("p").alias("p"))
    out = j.join(pivotal_round(fractional, seed), "key", "left")
    more = F.floor("extra") + F.when((F.col("p") > 0) & F.coalesce("up", F.lit(False)), 1).otherwise(0)
    return out.select("doc_id", "source", "size", "crc", "times", "source_size", "target", F.floor("ratio").cast("long").alias("copies"), more.cast("long").alias("more"))


def taken_rows(plan: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, copies): a row for each repetition in ``plan``; taken is size times copies."""
    each = plan.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))).alias("nth"))
    copies = F.col("copies") + F.when(F.col("nth") <= F.col("more"), 1).otherwise(0)
    return each.select("doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), "source", copies.alias("copies"))


#: Equal rows that one task numbers, on average.
NUMBERED_ROWS = 1000


def mix(documents: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, seed: int = 7) -> DataFrame:
    """``documents``, each row as often as the mix takes it: not at all, once, or up to ``most`` times.

    Texts may be null or of any length; a null source is a source of its own, the last. Rows that are equal in doc_id,
    source and text are decided together, so that as many of them are taken as their share of the target asks for. An
    empty table gives no rows. The columns stay as they are, whatever their names.
    """
    plan = written(plan_copies(narrow_rows(documents), weights, share, most, seed).where("copies + more > 0"), "plan")
    id_, crc = F.col("d.doc_id"), F.crc32(F.coalesce(F.col("d.text"), F.lit("")))
    same = id_.eqNullSafe(F.col("p.doc_id")) & F.col("d.source").eqNullSafe(F.col("p.source")) & (crc == F.col("p.crc")) & (n_words(F.col("d.text")) == F.col("p.size"))
    (nth,) = fresh(documents.columns, "nth")

    def repeated(rows: DataFrame, copies: Column) -> DataFrame:
        return rows.select("d.*", F.explode(F.sequence(F.lit(1).cast("long"), copies)).alias(nth)).drop(nth)

    # a row that isn't repeated gets one more copy or none; so do repetitions of which all get one
    whole = "more = 0 or more = times"
    copies = F.col("p.copies") + F.when(F.col("p.more") > 0, 1).otherwise(0)
    out = repeated(documents.alias("d").join(plan.where(whole).alias("p"), same), copies)
    parted, k = counted(plan.where(f"not ({whole})").withColumn("group", F.monotonically_increasing_id()), "parted")
    if not k:
        return out
    # the others are numbered, in slots of a group, to tell those that get one more copy
    row = F.struct(*[F.col(f"d.`{c}`") for c in documents.columns]).alias("d")
    slot = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.ceil(F.col("p.times") / NUMBERED_ROWS))
    rows = written(documents.alias("d").join(parted.alias("p"), same).select(row, F.col("p.group"), F.col("p.copies"), F.col("p.more"), slot.alias("slot"), F.monotonically_increasing_id().alias("at")), "parted")
    before = Window.partitionBy("group").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("group", "slot").agg(F.count(F.lit(1)).alias("n")).select("group", "slot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.row_number().over(Window.partitionBy("group", "slot").orderBy("at"))
    rows = rows.withColumn("place", place).join(starts, ["group", "slot"])
    copies = F.col("copies") + F.when(F.col("start") + F.col("place") <= F.col("more"), 1).otherwise(0)
    return out.unionByName(repeated(rows.where(copies > 0), copies))
