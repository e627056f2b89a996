"""Column profiles that merge: a day's profile holds sketches, so reports over many days need no second scan.

Distinct strings are counted by HyperLogLog sketches of 2^14 registers: the standard error is below 1%. Quantiles come from KLL sketches
of k = 400, whose ranks err by less than 1% of the rows at 99% confidence. The rest is exact, up to rounding. ``quality_report``
stays the exact way over one table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.functions.names import fresh
from recspark.operators.quality import NUMERIC

REGISTERS, KLL_K = 14, 400
#: Columns of a profile, behind those that it is grouped by.
PROFILE = ("name", "type", "total_count", "null_count", "distinct", "quantiles", "min", "max", "mean", "m2")


def column_profiles(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by`` and a row a group and scalar column: PROFILE. One aggregation, partly done before the shuffle, whatever the number of columns.

    Strings have ``distinct``, numbers the rest; a column without values has null statistics and empty sketches. NaN is a value and
    makes min, max or mean NaN where Spark's aggregates do; quantiles leave it out. The columns ``by`` aren't profiled. An empty
    table gives no rows.
    """
    cols = [(c, t) for c, t in df.dtypes if c not in by and (t == "string" or t in NUMERIC or t.startswith("decimal"))]
    total, item, *made = fresh(by, "total", "item", *[f"c{i}" for i in range(len(cols))])
    none, bare = F.lit(None).cast("double"), F.lit(None).cast("binary")
    aggs = [F.count(F.lit(1)).alias(total)]
    for (c, t), name in zip(cols, made, strict=True):
        q, num = F.col(f"`{c}`"), t != "string"
        v = q.cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("name"), F.lit("numeric" if num else "string").alias("type"), F.count_if(q.isNull()).alias("null_count"),
            (bare if num else F.hll_sketch_agg(q, REGISTERS)).alias("distinct"), (F.kll_sketch_agg_double(v, KLL_K) if num else bare).alias("quantiles"),
            (F.min(v) if num else none).alias("min"), (F.max(v) if num else none).alias("max"),
            (F.avg(v) if num else none).alias("mean"), (F.var_pop(v) * F.count(v) if num else none).alias("m2"),
        ).alias(name))
    groups = [F.col(f"`{c}`") for c in by]
    one = df.groupBy(*groups).agg(*aggs).where(F.col(total) > 0)
    if not cols:
        raise ValueError("no column of strings or numbers to profile")
    long = one.select(*groups, total, F.explode(F.array(*[F.col(c) for c in made])).alias(item))
    return long.select(*groups, *[(F.col(total) if c == "total_count" else F.col(f"{item}.{c}")).alias(c) for c in PROFILE])


def merged_profiles(profiles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The profiles of larger groups: those that ``by`` still tells apart, or of everything. Equal to profiles of all rows, sketches within their error.

    Squares are summed around the mean of the larger group, which a first pass over the profiles finds, so large values with small
    deviations keep their digits. Profiles are read twice: write costly ones first.
    """
    n, numeric = F.col("total_count") - F.col("null_count"), F.col("type") == "numeric"
    keys = [*by, "name", "type"]
    centre, *names = fresh(profiles.columns, "centre", *[f"k{i}" for i in range(len(keys))])
    held = F.when(n > 0, n)
    means = profiles.groupBy(*[F.col(f"`{k}`").alias(a) for k, a in zip(keys, names, strict=True)]).agg((F.sum(held * F.col("mean")) / F.sum(held)).alias(centre))
    same = [F.col(f"`{k}`").eqNullSafe(F.col(a)) for k, a in zip(keys, names, strict=True)]
    out = profiles.join(means, same).groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.sum("total_count").alias("total_count"), F.sum("null_count").alias("null_count"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.first(centre).alias("mean"), F.sum(F.when(n > 0, F.col("m2") + n * (F.col("mean") - F.col(centre)) * (F.col("mean") - F.col(centre)))).alias("m2"),
    )
    kept = {"distinct": F.when(~numeric, F.col("distinct")), "quantiles": F.when(numeric, F.col("quantiles"))}
    return out.withColumns(kept).select(*[F.col(f"`{c}`") for c in by], *PROFILE)


def report(profiles: DataFrame, stage: str) -> DataFrame:
    """The columns of ``quality_report`` from a profile; cardinality is the sketch's estimate."""
    n = F.col("total_count") - F.col("null_count")
    return profiles.select(
        F.lit(stage).alias("stage"), "total_count", "name", "type", "null_count", F.round(F.col("null_count") / F.col("total_count"), 6).alias("null_ratio"),
        F.when(F.col("type") == "string", F.hll_sketch_estimate("distinct")).alias("cardinality"), "min", "max", "mean", F.when(n > 1, F.sqrt(F.col("m2") / (n - 1))).alias("stddev"),
    )


def _filled() -> Column:
    return (F.col("type") == "numeric") & (F.col("total_count") > F.col("null_count"))


def quantiles(profiles: DataFrame, shares: Sequence[float]) -> DataFrame:
    """name, share, value of the numeric columns that have values."""
    at = F.array(*[F.lit(float(s)) for s in shares])
    values = F.kll_sketch_get_quantile_double("quantiles", at)
    return profiles.where(_filled()).select("name", F.explode(F.arrays_zip(at.alias("share"), values.alias("value"))).alias("q")).select("name", "q.share", "q.value")


#: Quantiles that stand for a distribution where two are compared.
POINTS = 500


def distribution_drift(now: DataFrame, before: DataFrame, far: float = 0.1) -> DataFrame:
    """name, distance, warn: how far the ranks of values have moved, at most, in numeric columns that both profiles have.

    The distance is Kolmogorov's between the two lists of POINTS quantiles, so it errs by twice the sketches' error and 1 / POINTS. A column
    without values in either profile is left out.
    """
    at = F.array(*[F.lit((i + 0.5) / POINTS) for i in range(POINTS)])
    new, old = (p.where(_filled()).select("name", F.kll_sketch_get_quantile_double("quantiles", at).alias(side)) for p, side in ((now, "now"), (before, "before")))

    def rank(side: str, value: Column) -> Column:
        return F.size(F.filter(side, lambda x: x <= value)) / POINTS

    gaps = F.transform(F.array_distinct(F.concat("now", "before")), lambda v: F.abs(rank("now", v) - rank("before", v)))
    return new.join(old, "name").select("name", F.array_max(gaps).alias("distance")).withColumn("warn", F.col("distance") > far)
