"""Vocabularies: value statistics, positions, targets, and their incremental merge.

A vocabulary entry is (field_index, key); its hash is attached for output only. Nothing is collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators import history_stats
from recspark.operators.indexing import global_index
from recspark.operators.registry import TOKEN, Feature, Registry
from recspark.sources.scratch import written

EPSILON = 1e-6
STATS = ("cnt", "sum", "sum_sq", "mean", "m2")


def value_stats(tokens: DataFrame) -> DataFrame:
    """cnt, sum, sum_sq, mean and m2 of the values of every (field_name, field_index, field_type, key), partly summed before the shuffle."""
    v = F.col("value")
    return tokens.groupBy("field_name", "field_index", "field_type", "key").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum(v).alias("sum"), F.sum(v * v).alias("sum_sq"), F.avg(v).alias("mean"), (F.var_pop(v) * F.count(F.lit(1))).alias("m2")
    )


def feature_stats(registry: Registry, rows: DataFrame, key: str = "sample_id") -> DataFrame:
    """``value_stats`` of the tokens of ``rows``. Features of single elements of a history are counted once an element, others of a history without tokens.

    Where no other feature is left that reads the history, the others' tokens are made once for all rows alike in what they read.
    """
    once, counted = registry.by_element(), registry.by_history()
    names = {f.name for f in [*once, *counted]}
    rest = [f for f in registry.active() if f.name not in names]
    partial = [_element_partials(rows, registry.histories, once)] if once else []
    parts = []
    if rest and registry.histories is not None and all(f.reads for f in rest):
        partial.append(_alike_partials(rows, rest))
    elif rest or not names:
        parts.append(value_stats(registry.tokens(rows, key, [f.name for f in rest])))
    if counted:
        partial.append(history_stats.partial_stats(rows, registry.histories, counted))
    if partial:
        parts.append(_pooled(written(reduce(DataFrame.unionByName, partial), "partial")))
    return reduce(DataFrame.unionByName, parts)


def _element_partials(rows: DataFrame, histories: DataFrame, features: list[Feature]) -> DataFrame:
    """Partial rows of the elements before each row, of which none is made for a row: an element counts as often as its user has rows that are later.

    Rows are counted by the place where their history begins, of which a user has as many as elements.
    """
    known = histories.where("user_id is not null").select("user_id", F.filter("seq", lambda e: e["ts"].isNotNull()).alias("seq"))
    times = known.select("user_id", F.col("seq.ts").alias("times"))
    begun = rows.select("user_id", "time_stamp").join(times.hint("merge"), "user_id")
    begun = begun.withColumn("pos", F.size("times") - F.size(F.filter("times", lambda t: t < F.col("time_stamp")))).groupBy("user_id", "pos").agg(F.count(F.lit(1)).alias("begun"))
    elements = known.select("user_id", F.posexplode("seq").alias("pos", "e")).join(begun, ["user_id", "pos"], "left")
    until = Window.partitionBy("user_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    elements = elements.select("e", F.coalesce(F.sum("begun").over(until), F.lit(0)).alias("n")).where("n > 0")
    made = [F.struct(F.lit(f.name).alias("field_name"), F.lit(f.index).alias("field_index"), F.lit(f.kind).alias("field_type"), f.element(F.col("e")).alias("t")) for f in features]
    tokens = elements.select("n", F.explode(F.array(*made)).alias("f")).where("f.t is not null")
    return _weighted_partials(tokens.select("f.field_name", "f.field_index", "f.field_type", "f.t.key", "f.t.value", "n"))


def _alike_partials(rows: DataFrame, features: list[Feature]) -> DataFrame:
    """Partial rows of features of named columns: one pass counts the rows of each value of each column, or of the read fields of a struct, and a value makes its tokens once."""
    fields: dict[str, list[str]] = {}
    for name in sorted({name for f in features for name in f.reads}):
        top, _, inner = name.partition(".")
        fields.setdefault(top, []).append(inner)
    sets = sorted({tuple(sorted({name.partition(".")[0] for name in f.reads})) for f in features})
    kept = {top: F.col(top) if "" in inner else F.when(F.col(top).isNotNull(), F.struct(*[F.col(f"{top}.{i}").alias(i) for i in inner])).alias(top) for top, inner in fields.items()}
    rows = rows.select(*[c.alias(top) for top, c in kept.items()])
    dealt = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in fields]).agg(F.grouping_id().alias("set"), F.count(F.lit(1)).alias("n"))
    # a bit of the set's number is 1 for a column that isn't in it, the first column's the highest
    numbers = {s: sum(1 << (len(fields) - 1 - i) for i, c in enumerate(fields) if c not in s) for s in sets}
    made = []
    for f in features:
        mine = F.col("set") == numbers[tuple(sorted({name.partition(".")[0] for name in f.reads}))]
        made.append(F.struct(F.lit(f.name).alias("field_name"), F.lit(f.index).alias("field_index"), F.lit(f.kind).alias("field_type"), F.when(mine, f.build().cast(TOKEN)).alias("list")))
    tokens = dealt.select("n", F.explode(F.array(*made)).alias("f")).select("n", "f.field_name", "f.field_index", "f.field_type", F.explode("f.list").alias("t"))
    return _weighted_partials(tokens.select("field_name", "field_index", "field_type", "t.key", "t.value", "n"))


def _weighted_partials(tokens: DataFrame) -> DataFrame:
    """Partial rows of tokens that each stand for n."""
    by = ["field_name", "field_index", "field_type", "key"]
    values = tokens.groupBy(*by, "value").agg(F.sum("n").alias("n"))
    n, v = F.col("n"), F.col("value")
    return values.select(
        *by, "n", F.when(v.isNull(), 0).otherwise(n).alias("valued"), (n * v).alias("sum"), (n * v * v).alias("sum_sq"), v.alias("mean"), F.when(v.isNotNull(), 0.0).alias("m2")
    )


def _pooled(partial: DataFrame) -> DataFrame:
    """``value_stats`` of partial rows (``history_stats.PARTIAL``), which are read twice."""
    by = ["field_name", "field_index", "field_type", "key"]
    # squares are summed around a mean of the key's means, as large values would cancel out
    centers = partial.groupBy(*by).agg(F.avg("mean").alias("center"))
    same = F.lit(True)
    for c in by:
        same = same & F.col(f"v.{c}").eqNullSafe(F.col(f"c.{c}"))
    around = partial.alias("v").join(centers.alias("c"), same).select("v.*", "center").withColumn("off", F.col("mean") - F.col("center"))
    n, valued, off = F.sum("n"), F.nullif(F.sum("valued"), F.lit(0)), F.col("off")
    spread = F.sum(F.col("m2") + F.col("valued") * off * off) / valued - F.pow(F.sum(F.col("valued") * off) / valued, F.lit(2))
    return around.groupBy(*by).agg(
        n.alias("cnt"), F.sum("sum").alias("sum"), F.sum("sum_sq").alias("sum_sq"), (F.sum("sum") / valued).alias("mean"), F.when(valued.isNotNull(), F.greatest(spread, F.lit(0.0)) * n).alias("m2")
    )


def std(m2: Column, cnt: Column) -> Column:
    """sqrt(max(variance, 0) + 1e-6); 1 without values."""
    return F.when(cnt > 0, F.sqrt(F.greatest(m2 / cnt, F.lit(0.0)) + EPSILON)).otherwise(F.lit(1.0))


def merged(a: dict[str, Column], b: dict[str, Column]) -> dict[str, Column]:
    """Statistics of two batches together by Chan's formula; a missing batch counts as empty."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    na, nb = (F.coalesce(x["cnt"], F.lit(0)) for x in (a, b))
    n, delta = na + nb, zero(b["mean"]) - zero(a["mean"])
    share = F.when(n > 0, nb / n).otherwise(F.lit(0.0))
    return {
        "cnt": n,
        "sum": zero(a["sum"]) + zero(b["sum"]),
        "sum_sq": zero(a["sum_sq"]) + zero(b["sum_sq"]),
        "mean": zero(a["mean"]) + delta * share,
        "m2": zero(a["m2"]) + zero(b["m2"]) + delta * delta * na * share,
    }


def from_sums(cnt: Column, total: Column, squares: Column) -> dict[str, Column]:
    """mean and m2 rebuilt from a stored sum and sum of squares."""
    mean = F.when(cnt > 0, total / cnt).otherwise(F.lit(0.0))
    return {"cnt": cnt, "sum": total, "sum_sq": squares, "mean": mean, "m2": F.greatest(squares - cnt * mean * mean, F.lit(0.0))}


def shared_stats(stats: DataFrame, threshold: int) -> DataFrame:
    """(field_index, field_type, key) with merged statistics of the field names that reach the threshold.

    The threshold holds for each field name; names with one index share their entries.
    """
    s = stats.where(F.col("cnt") >= threshold)
    # pooled m2 = sum of m2 + sum of cnt * mean^2 - total * pooled mean^2, exact in one pass
    pooled = s.groupBy("field_index", "field_type", "key").agg(
        F.sum("cnt").alias("cnt"), F.sum("sum").alias("sum"), F.sum("sum_sq").alias("sum_sq"), F.sum("m2").alias("within"), F.sum(F.col("cnt") * F.col("mean") * F.col("mean")).alias("between")
    )
    mean = F.col("sum") / F.col("cnt")
    return pooled.withColumn("mean", mean).withColumn("m2", F.greatest(F.col("within") + F.col("between") - F.col("cnt") * mean * mean, F.lit(0.0))).drop("within", "between")


def build_pos_map(stats: DataFrame, threshold: int = 1, previous: DataFrame | None = None) -> DataFrame:
    """field_index, field_type, key, pos and statistics.

    Positions count from 1 in each (field_index, field_type), more frequent keys first, ties by key; slot 0 is
    reserved. A continuous field has position 1. With ``previous``, known keys keep their positions, whatever their count
    now, and new ones follow behind the largest; statistics of both are merged.
    """
    key = ["field_index", "field_type", "key"]
    new = shared_stats(stats, threshold)
    if previous is not None:
        new = new.join(previous.select(*key), key, "left_anti")
        tops = previous.groupBy("field_index", "field_type").agg(F.max("pos").alias("top"))
    numbered = global_index(new, [F.col("cnt").desc(), F.col("key")], "__at", within=("field_index", "field_type"))
    base: Column = F.lit(0)
    if previous is not None:
        numbered = numbered.join(tops, ["field_index", "field_type"], "left")
        base = F.coalesce("top", F.lit(0))
    pos = F.when(F.col("field_type") == 0, F.lit(1)).otherwise(F.col("__at") + 1 + base).cast("long")
    fresh = numbered.select(*key, pos.alias("pos"), *STATS)
    if previous is None:
        return fresh
    now = shared_stats(stats, 1).select(*key, *[F.col(c).alias(f"b_{c}") for c in STATS])
    kept = previous.select(*key, "pos", *[F.col(c).alias(f"a_{c}") for c in STATS]).join(now, key, "left")
    both = merged({c: F.col(f"a_{c}") for c in STATS}, {c: F.col(f"b_{c}") for c in STATS})
    return kept.select(*key, "pos", *[both[c].alias(c) for c in STATS]).unionByName(fresh)


def pos_dim(pos_map: DataFrame, fields: DataFrame) -> DataFrame:
    """field_name, field_index, field_type, dim: positions of a field with its slot 0, shared by names of one index."""
    dims = pos_map.groupBy("field_index", "field_type").agg((F.max("pos") + 1).alias("dim"))
    return fields.join(dims, ["field_index", "field_type"], "left").select("field_name", "field_index", "field_type", F.coalesce("dim", F.lit(1)).cast("long").alias("dim"))


def exported(pos_map: DataFrame) -> DataFrame:
    """Positions with mean and std for models: (0, 1) for categorical fields, the real ones for continuous."""
    cat = F.col("field_type") == 1
    return pos_map.select("field_index", "field_type", "key", "pos", F.when(cat, 0.0).otherwise(F.col("mean")).alias("mean"), F.when(cat, 1.0).otherwise(std(F.col("m2"), F.col("cnt"))).alias("std"))


def build_target_map(targets: DataFrame, threshold: int = 1, previous: DataFrame | None = None) -> DataFrame:
    """target, idx, cnt: dense indexes from 0, more frequent targets first, ties by target; with ``previous`` old ones stay."""
    counts = targets.groupBy("target").agg(F.count(F.lit(1)).alias("cnt"))
    new = counts.where(F.col("cnt") >= threshold)
    if previous is None:
        return global_index(new, [F.col("cnt").desc(), F.col("target")], "idx").select("target", F.col("idx").cast("long").alias("idx"), "cnt")
    new = new.join(previous.select("target"), "target", "left_anti")
    top = previous.agg(F.coalesce(F.max("idx") + 1, F.lit(0)).alias("top"))
    fresh = global_index(new, [F.col("cnt").desc(), F.col("target")], "at").crossJoin(F.broadcast(top))  # one row
    kept = previous.select("target", "idx", F.col("cnt").alias("old")).join(counts, "target", "left")
    kept = kept.select("target", "idx", (F.col("old") + F.coalesce("cnt", F.lit(0))).alias("cnt"))
    return kept.unionByName(fresh.select("target", (F.col("at") + F.col("top")).cast("long").alias("idx"), "cnt"))


def build_report(stats: DataFrame, threshold: int, previous: DataFrame | None = None) -> DataFrame:
    """One row: total, new, existing and below-threshold keys, and occurrences."""
    key = ["field_index", "field_type", "key"]
    known = (previous.select(*key).withColumn("known", F.lit(True)) if previous is not None else stats.select(*key).limit(0).withColumn("known", F.lit(True)))
    j = stats.join(known, key, "left").withColumn("known", F.coalesce("known", F.lit(False)))
    return j.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("known") & (F.col("cnt") >= threshold)).alias("new"),
        F.count_if("known").alias("existing"),
        F.count_if(~F.col("known") & (F.col("cnt") < threshold)).alias("below"),
        F.sum("cnt").alias("occurrences"),
    )


def frequency_histogram(pos_map: DataFrame) -> DataFrame:
    """cnt, keys, share, cumulative share: how many keys occur how often. The window runs over distinct counts."""
    h = pos_map.groupBy("cnt").agg(F.count(F.lit(1)).alias("n_keys"))
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum("n_keys").over(everything)
    return h.select("cnt", "n_keys", F.round(F.col("n_keys") / total, 6).alias("share"), F.round(F.sum("n_keys").over(Window.orderBy("cnt")) / total, 6).alias("cum_share"))


def frequency_summary(pos_map: DataFrame) -> DataFrame:
    return pos_map.agg(
        F.count(F.lit(1)).alias("n_keys"), F.min("cnt").alias("min_cnt"), F.max("cnt").alias("max_cnt"), F.avg("cnt").alias("mean_cnt"), F.percentile("cnt", 0.5).alias("median_cnt"), F.count_if(F.col("cnt") == 1).alias("singletons")
    )
