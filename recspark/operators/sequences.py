"""Item statistics, behaviour sequences, and the joined sample."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recspark.operators.indexing import global_index


def item_counts(ix: DataFrame, approximate: bool = False) -> DataFrame:
    """item_id, rate_count (distinct users), avg_rate rounded to two places."""
    users = F.approx_count_distinct("user_id") if approximate else F.count_distinct("user_id")
    return ix.groupBy("item_id").agg(users.alias("rate_count"), F.round(F.avg("rating"), 2).alias("avg_rate"))


def item_stats(ix: DataFrame, items: DataFrame) -> DataFrame:
    """Items with interactions: title, genres, genre_cnt, rate_count, avg_rate and hot_rank (1 is the most popular)."""
    joined = item_counts(ix).join(items, "item_id")
    ranked = global_index(joined, [F.col("rate_count").desc(), F.col("item_id")], "hot_rank")
    return ranked.select("item_id", "title", "genres", F.size("genres").alias("genre_cnt"), "rate_count", "avg_rate", (F.col("hot_rank") + 1).cast("long").alias("hot_rank"))


def item_stats_left(ix: DataFrame, items: DataFrame) -> DataFrame:
    """All items; those without interactions have zeros."""
    return items.join(item_counts(ix), "item_id", "left").withColumns({"rate_count": F.coalesce("rate_count", F.lit(0)), "avg_rate": F.coalesce("avg_rate", F.lit(0.0))})


def latest_per_user_item(ix: DataFrame) -> DataFrame:
    """The last interaction of each user with each item; a tie in time goes to the higher rating."""
    other = [c for c in ix.columns if c not in ("user_id", "item_id")]
    best = F.max(F.struct("time_stamp", "rating", *[c for c in other if c not in ("time_stamp", "rating")])).alias("m")
    return ix.groupBy("user_id", "item_id").agg(best).select("user_id", "item_id", *[F.col(f"m.{c}") for c in other])


def user_sequences(ix: DataFrame, n: int = 200, latest: bool = True, value: str = "rating") -> DataFrame:
    """user_id and ``seq``: the n most recent array<struct<item_id, rating, ts>> of each user, newest first, ties by item.

    latest keeps the last interaction per item; otherwise exact duplicates are dropped. Spark limits each task to n
    rows a user before it shuffles.
    """
    rows = latest_per_user_item(ix) if latest else ix.dropDuplicates(["user_id", "item_id", value, "time_stamp"])
    w = Window.partitionBy("user_id").orderBy(F.col("time_stamp").desc(), F.col("item_id"), F.col(value).desc())
    top = rows.withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= n)
    element = F.struct("rk", F.struct("item_id", F.col(value).alias("rating"), F.col("time_stamp").alias("ts")).alias("v"))
    grouped = top.groupBy("user_id").agg(F.array_sort(F.collect_list(element)).alias("a"))
    return grouped.select("user_id", F.transform("a", lambda x: x["v"]).alias("seq"))


def sequence_text(seqs: DataFrame, with_time: bool = True) -> DataFrame:
    """``item:rating:ts,...`` (or ``item:rating,...``) of each sequence."""

    def one(x):
        parts = [x["item_id"], x["rating"].cast("string")] + ([x["ts"].cast("string")] if with_time else [])
        return F.concat_ws(":", *parts)

    return seqs.select("user_id", F.concat_ws(",", F.transform("seq", one)).alias("seq"))


def with_genres(seqs: DataFrame, items: DataFrame) -> DataFrame:
    """Sequences whose elements carry their item's genres, null for an unknown item."""
    flat = seqs.select("user_id", F.posexplode("seq").alias("pos", "e")).select("user_id", "pos", "e.*")
    joined = flat.join(items.select("item_id", "genres"), "item_id", "left")
    element = F.struct("pos", F.struct("item_id", "rating", "ts", "genres").alias("v"))
    return joined.groupBy("user_id").agg(F.array_sort(F.collect_list(element)).alias("a")).select("user_id", F.transform("a", lambda x: x["v"]).alias("seq"))


def join_samples(ix: DataFrame, users: DataFrame, seqs: DataFrame | None, stats: DataFrame) -> DataFrame:
    """Every interaction with user_profile and item_feature structs and, where given, its user's sequence; what is missing is null.

    Sequences, many times the size of a row, are joined last, so that no shuffle carries them on rows.
    """
    u = users.select("user_id", F.struct("gender", "age", "occupation", "zip_code").alias("user_profile"))
    i = stats.select("item_id", F.struct("title", "genres", "genre_cnt", "rate_count", "avg_rate", "hot_rank").alias("item_feature"))
    joined = ix.join(i, "item_id", "left").join(u, "user_id", "left")
    if seqs is not None:
        joined = joined.join(seqs.select("user_id", F.col("seq").alias("user_behavior")), "user_id", "left")
    own = [c for c in ix.columns if c not in ("item_id", "user_id")]
    return joined.select("item_id", "user_id", *[F.col(f"`{c}`") for c in own], "user_profile", *(["user_behavior"] if seqs is not None else []), "item_feature")


def star_join(facts: DataFrame, ads: DataFrame, profiles: DataFrame, seqs: DataFrame) -> DataFrame:
    """Impressions with their ad, profile and sequence, each optional."""
    return facts.join(ads, "item_id", "left").join(profiles, "user_id", "left").join(seqs, "user_id", "left")


def as_json(samples: DataFrame) -> DataFrame:
    """The nested columns as JSON strings, for consumers of flat files; nulls become {}."""
    nested = [c for c, t in samples.dtypes if t.startswith(("struct", "array"))]
    return samples.withColumns({c: F.coalesce(F.to_json(F.col(c)), F.lit("{}")) for c in nested})
