"""Negative sampling: items that a user hasn't seen, uniform, by popularity, or both.

``sample_negatives`` ranks every candidate of a positive by a key of its own; that law costs positives times items, whatever
the plan. ``drawn`` is the way at scale: it selects places among a user's unseen items, so that its work grows with
positives times k. Both give k negatives or all there are, with the same chances; the items differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators.indexing import running_sums
from recspark.operators.split import unit
from recspark.sources.scratch import written

#: Positives times items up to which the pool is broadcast and paired with every positive; above, each user's unseen items are found once. The result is the same.
RANK_LIMIT = 2_000_000


def popularity(ix: DataFrame) -> DataFrame:
    """item_id, pop: distinct users of each item."""
    return ix.groupBy("item_id").agg(F.count_distinct("user_id").alias("pop"))


def candidates(positives: DataFrame, pool: DataFrame, history: DataFrame) -> DataFrame:
    """(user_id, item_id, cand, pop) of every positive and every item of the pool that its user has no interaction with.

    The pool must be small: its rows are paired with every positive. ``history`` includes the positives.
    """
    pairs = positives.select("user_id", "item_id").distinct().crossJoin(F.broadcast(pool.select(F.col("item_id").alias("cand"), "pop")))
    seen = history.select("user_id", F.col("item_id").alias("cand")).distinct()
    return pairs.where("cand <> item_id").join(seen, ["user_id", "cand"], "left_anti")


def _unseen_candidates(positives: DataFrame, pool: DataFrame, history: DataFrame) -> DataFrame:
    """The rows of ``candidates`` for pools of any size: the unseen items of each user are found once and joined to the positives."""
    pos = positives.select("user_id", "item_id").distinct()
    seen = history.select("user_id", F.col("item_id").alias("cand")).distinct()
    pairs = pos.select("user_id").distinct().crossJoin(pool.select(F.col("item_id").alias("cand"), "pop"))
    return pos.join(pairs.join(seen, ["user_id", "cand"], "left_anti"), "user_id").where("cand <> item_id").select("user_id", "item_id", "cand", "pop")


def _key(strategy: str, seed: int) -> Column:
    u = unit(F.col("user_id"), F.col("item_id"), F.col("cand"), seed=seed)
    # the smallest of exponential times with these rates comes first: weighted sampling without replacement
    return -F.log(u) / F.pow(F.greatest(F.coalesce("pop", F.lit(1)), F.lit(1)).cast("double"), F.lit(0.75)) if strategy == "popular" else u


def ranked(cands: DataFrame, k: int, strategy: str, seed: int = 42) -> DataFrame:
    """The k first candidates of each positive by a random key, uniform or by popularity to the power 0.75, without repeats."""
    w = Window.partitionBy("user_id", "item_id").orderBy(F.round(_key(strategy, seed), 9), F.col("cand"))
    return cands.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k)


def mixed(cands: DataFrame, k: int, seed: int = 42) -> DataFrame:
    """k // 2 popular candidates, then uniform ones that aren't among them, up to k."""
    pop = ranked(cands, k // 2, "popular", seed).select("user_id", "item_id", "cand", F.lit(0).alias("part"), "rk")
    uni = ranked(cands, k, "uniform", seed + 1).select("user_id", "item_id", "cand", F.lit(1).alias("part"), "rk")
    both = pop.unionByName(uni).groupBy("user_id", "item_id", "cand").agg(F.min(F.struct("part", "rk")).alias("o"))
    w = Window.partitionBy("user_id", "item_id").orderBy("o", "cand")
    return both.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= k).drop("o")


#: Parts of one that a weight is rounded to.
WEIGHT_UNIT = 1 << 20
#: Items up to which the line of items is broadcast: a row is an id and four numbers.
BROADCAST_ITEMS = 1_000_000


def _on_a_line(pool: DataFrame, popular: bool) -> tuple[DataFrame, int, int]:
    """(the items by id, each with its number, its whole-number weight and where its weight starts; number of items; sum of weights)."""
    weight = F.pow(F.greatest(F.coalesce("pop", F.lit(1)), F.lit(1)).cast("double"), F.lit(0.75)) * WEIGHT_UNIT if popular else F.lit(1)
    weighed = pool.select("item_id", F.greatest(F.floor(F.round(weight, 6)), F.lit(1)).cast("long").alias("w"))
    line = written(running_sums(weighed, [F.col("item_id")], {"number": F.lit(1), "start": F.col("w")}), "line")
    total = line.agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w")).first()
    return line, total["n"], total["w"] or 0


def _found(targets: DataFrame, seen: DataFrame, line: DataFrame, n: int, weight: int, by: str) -> DataFrame:
    """``targets`` (user_id, y and others) with the user's unseen item at y: cand, w and its unseen places at_n, at_w.

    ``by`` is n where y counts unseen items, w where it counts their weight. A seen item stands at the unseen place that it would
    begin at, so the seen items up to y tell by how much y is moved; then y is a place on the line of all items.
    """
    moves = seen.select("user_id", F.col(f"at_{by}").alias("y"), F.col("w").alias("by_w"), F.lit(1).alias("by_n"), F.lit(0).alias("kind"))
    both = targets.withColumn("kind", F.lit(1)).unionByName(moves, allowMissingColumns=True)
    moved = running_sums(both, [F.col("y"), F.col("kind")], {"off_w": F.col("by_w"), "off_n": F.col("by_n")}, within=("user_id",))
    moved = moved.where("kind = 1").drop("kind", "by_w", "by_n")
    if by == "n":
        out = moved.withColumn("number", F.col("y") + F.col("off_n")).join(line, "number")
    else:
        # an item lies in every block that its weight reaches into; of four blocks an item, a place meets 1.25 items on average
        size = max(1, weight // (4 * n))
        block = F.explode(F.sequence(F.expr(f"start div {size}"), F.expr(f"(start + w - 1) div {size}")))
        placed = moved.withColumn("z", F.col("y") + F.col("off_w"))
        out = placed.withColumn("block", F.expr(f"z div {size}")).join(line.withColumn("block", block), "block").where("start <= z and z < start + w").drop("z", "block")
    out = out.withColumns({"at_n": F.col("number") - F.col("off_n"), "at_w": F.col("start") - F.col("off_w")})
    return out.withColumnRenamed("item_id_", "cand").drop("off_w", "off_n", "number", "start", "y")


def _whole(what: str, seed: int, d: Column) -> Column:
    """60 random bits that the seed, the positive and the number of the draw decide."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(what), F.col("user_id").cast("string"), F.col("item_id").cast("string"), d.cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _next(places: Column, d: Column, before: int, seed: int) -> Column:
    """Unseen places with another one that isn't among them; draw ``d`` follows ``before`` draws that ``left_n`` no longer counts."""
    r = _whole("uniform", seed, d) % (F.col("left_n") - (d - before - 1))
    y = F.aggregate(F.array_sort(places), r, lambda at, g: F.when(g <= at, at + 1).otherwise(at))
    return F.concat(places, F.array(y))


def drawn(positives: DataFrame, pool: DataFrame, history: DataFrame, k: int, strategy: str = "uniform", seed: int = 42) -> DataFrame:
    """(user_id, item_id, cand, rk): k unseen items for each distinct positive, or all there are, by selection among the unseen.

    Items lie on a line in the order of their ids, each as long as its weight (1 where uniform). What a user has seen is cut out, and a draw is a
    place on what is left, so every draw hits: it is moved by the seen items before it, which one ordered pass over a user's seen items and draws
    tells. Items drawn before are skipped in the same way, from the positive's own list of at most k. So there are no rejections, and work
    grows with positives times k and the history, not with users times items; a user with any number of either is spread over tasks.

    ``uniform`` takes all k in one pass, ``popular`` (by popularity to the power 0.75) one pass a draw, and ``mixed`` draws k // 2 by
    popularity, then the rest uniformly among the others. Users may be null: those are one user. Items seen that aren't in the pool don't matter.
    """
    line, n, weight = _on_a_line(pool, strategy != "uniform")
    pos = positives.select("user_id", "item_id").distinct()
    if not n:
        return pos.select("user_id", "item_id", F.col("item_id").alias("cand"), F.lit(0).alias("rk")).limit(0)
    near = F.broadcast(line) if n <= BROADCAST_ITEMS else line
    mine = history.select("user_id", "item_id").unionByName(pos).distinct().join(near, "item_id").drop("item_id")
    seen = running_sums(mine, [F.col("number")], {"before_n": F.lit(1), "before_w": F.col("w")}, within=("user_id",))
    seen = written(seen.select("user_id", "w", (F.col("number") - F.col("before_n")).alias("at_n"), (F.col("start") - F.col("before_w")).alias("at_w")), "seen")
    taken = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_seen"), F.sum("w").alias("w_seen")).withColumnRenamed("user_id", "owner")
    rows = pos.join(taken, F.col("user_id").eqNullSafe(F.col("owner")), "left").drop("owner")
    rows = rows.select("user_id", "item_id", (n - F.coalesce("n_seen", F.lit(0))).alias("left_n"), (weight - F.coalesce("w_seen", F.lit(0))).alias("left_w"))
    line = near.withColumnRenamed("item_id", "item_id_")
    gone = F.array().cast("array<struct<at_w:bigint,w:bigint,at_n:bigint,cand:string>>")
    rows = written(rows.withColumn("gone", gone), "positives")
    weighed = {"uniform": 0, "popular": k, "mixed": k // 2}[strategy]
    for d in range(1, weighed + 1):
        open_ = rows.where("left_w > 0").withColumn("r", _whole("popular", seed, F.lit(d)) % F.col("left_w"))
        y = F.aggregate(F.array_sort("gone"), F.col("r"), lambda at, g: F.when(g["at_w"] <= at, at + g["w"]).otherwise(at))
        got = _found(open_.withColumn("y", y).drop("r"), seen, line, n, weight, "w")
        entry = F.struct("at_w", "w", "at_n", F.col("cand").cast("string").alias("cand"))
        more = got.select("user_id", "item_id", (F.col("left_n") - 1).alias("left_n"), (F.col("left_w") - F.col("w")).alias("left_w"), F.concat("gone", F.array(entry)).alias("gone"))
        rows = written(more.unionByName(rows.where("left_w <= 0")), "draw")
    kind = dict(pool.dtypes)["item_id"]
    out = rows.select("user_id", "item_id", F.posexplode("gone").alias("rk", "g")).select("user_id", "item_id", F.col("g.cand").cast(kind).alias("cand"), (F.col("rk") + 1).alias("rk"))
    if weighed == k:
        return out
    first = F.transform("gone", lambda g: g["at_n"])

    numbers = F.sequence(F.lit(weighed + 1), F.lit(k))
    # what is free shrinks by one a draw
    places = F.aggregate(numbers, first, lambda got, d: F.when(F.col("left_n") > d - weighed - 1, _next(got, d, weighed, seed)).otherwise(got))
    left = rows.where("left_n > 0").select("user_id", "item_id", F.posexplode(F.slice(places, F.size("gone") + 1, F.lit(k))).alias("rk", "y"), F.size("gone").alias("had"))
    uniform = _found(left, seen, line, n, weight, "n").select("user_id", "item_id", "cand", (F.col("rk") + F.col("had") + 1).alias("rk"))
    return out.unionByName(uniform)


def sample_negatives(positives: DataFrame, pool: DataFrame, history: DataFrame, k: int, strategy: str, seed: int = 42) -> DataFrame:
    """(user_id, item_id, cand, rk): k unseen items for each positive, fewer if there are fewer; the same at every size of input."""
    small = positives.count() * pool.count() <= RANK_LIMIT
    c = (candidates if small else _unseen_candidates)(positives, pool, history)
    out = mixed(c, k, seed) if strategy == "mixed" else ranked(c, k, strategy, seed)
    return out.select("user_id", "item_id", "cand", "rk")


def with_negatives(positives: DataFrame, negatives: DataFrame, item_features: DataFrame | None = None) -> DataFrame:
    """Positives with label 1, and for each negative a copy of its positive's row with the other item, rating 0, label 0.

    A positive without candidates stays alone. Columns of ``item_features`` replace the positive's on negative rows.
    """
    pos = positives.withColumn("label", F.lit(1))
    neg = positives.join(negatives.select("user_id", "item_id", "cand"), ["user_id", "item_id"])
    neg = neg.drop("item_id").withColumnRenamed("cand", "item_id").withColumns({"rating": F.lit(0), "label": F.lit(0)})
    if item_features is not None:
        own = [c for c in item_features.columns if c != "item_id"]
        neg = neg.drop(*own).join(item_features, "item_id", "left")
    return pos.unionByName(neg, allowMissingColumns=True)
