"""Point-in-time statistics of a user's history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions import scalars as X
from recspark.functions.names import fresh

DAYS = (1, 3, 7, 15, 30)


def with_history(samples: DataFrame, seqs: DataFrame) -> DataFrame:
    """``samples`` with ``history``: the elements of the user's sequence before the sample, empty without any."""
    joined = samples.join(seqs.select("user_id", "seq"), "user_id", "left")
    empty = F.array().cast(dict(seqs.dtypes)["seq"])
    return joined.withColumn("history", X.within(F.coalesce("seq", empty), F.col("time_stamp"), None)).drop("seq")


def snapshot_stats(samples: DataFrame, days: tuple[int, ...] = DAYS) -> DataFrame:
    """cnt_, avg_ and std_ of ``history`` for all of it and for each window of days.

    Each window is a column that is made once a row, the next smaller one from it, so work grows with the length of a history.
    """
    kept, wider = samples, "history"
    spans = dict(zip([None, *sorted(days, reverse=True)], fresh(samples.columns, *[f"h{i}" for i in range(len(days) + 1)]), strict=True))
    for d, name in spans.items():
        samples, wider = samples.withColumn(name, X.within(F.col(f"`{wider}`"), F.col("time_stamp"), d)), name
    out = {}
    for d in (None, *days):
        h, name = F.col(f"`{spans[d]}`"), "all" if d is None else str(d)
        out |= {f"cnt_{name}": F.size(h).cast("long"), f"avg_{name}": X.mean_rating(h), f"std_{name}": X.std_rating(h)}
    return samples.withColumns(out).select(*[F.col(f"`{c}`") for c in kept.columns if c not in out], *[F.col(c) for c in out])


def as_of_stats(ix: DataFrame, days: tuple[int, ...] = DAYS) -> DataFrame:
    """The same from the user's whole history, by range windows that end a second before each row."""
    base = Window.partitionBy("user_id").orderBy("time_stamp")
    out = {}
    for d in (None, *days):
        w = base.rangeBetween(Window.unboundedPreceding if d is None else -d * X.DAY, -1)
        name = "all" if d is None else str(d)
        out[f"cnt_{name}"] = F.count(F.lit(1)).over(w)
        out[f"avg_{name}"] = F.coalesce(F.avg("rating").over(w), F.lit(3.0))
        out[f"std_{name}"] = F.coalesce(F.stddev_pop("rating").over(w), F.lit(0.0))
    return ix.withColumns(out)


def active_days(ix: DataFrame) -> DataFrame:
    """active_days: distinct days of the user before the sample's day, by first occurrences of days."""
    days = ix.select("user_id", "day").distinct()
    before = Window.partitionBy("user_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    counted = days.withColumn("active_days", F.count(F.lit(1)).over(before))
    return ix.join(counted, ["user_id", "day"])


def genre_affinity(samples: DataFrame) -> DataFrame:
    """sample_id, genre and for all, 1, 3, 7, 15 days the count and mean rating of the history's elements of that genre.

    One explosion and one aggregation serve all windows; a window without elements has count 0 and mean null.
    """
    flat = samples.select("sample_id", "time_stamp", F.explode("history").alias("h"))
    flat = flat.select("sample_id", (F.col("time_stamp") - F.col("h.ts")).alias("age"), F.col("h.rating").alias("rating"), F.explode("h.genres").alias("genre"))
    aggs = [F.count(F.lit(1)).alias("cnt_all"), F.avg("rating").alias("avg_all")]
    for d in DAYS[:4]:
        on = F.col("age") <= d * X.DAY
        aggs += [F.count_if(on).alias(f"cnt_{d}"), F.avg(F.when(on, F.col("rating"))).alias(f"avg_{d}")]
    return flat.groupBy("sample_id", "genre").agg(*aggs)
