"""Cleaning of raw interactions and profiles. Nothing throws on malformed input; rows that don't parse are dropped or flagged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recspark.functions.scalars import day_of, to_millis, try_int

KEY = ("user_id", "item_id", "rating", "time_stamp")


def clean_ratings(raw: DataFrame) -> DataFrame:
    """user_id, item_id, rating, time_stamp, day: numeric ids of 0 or more, ratings 1..5, a time; exact duplicates once."""
    typed = raw.select(
        F.trim("user_id").alias("user_id"), F.trim("item_id").alias("item_id"), try_int(F.col("rating")).alias("rating"), F.trim(F.col("time_stamp").cast("string")).try_cast("long").alias("time_stamp")
    )
    valid = typed.where((F.col("user_id").try_cast("long") >= 0) & (F.col("item_id").try_cast("long") >= 0) & F.col("rating").between(1, 5) & F.col("time_stamp").isNotNull())
    return valid.dropDuplicates(list(KEY)).withColumn("day", day_of(F.col("time_stamp")))


def clean_app_interactions(raw: DataFrame) -> DataFrame:
    """App reviews: non-empty ids, ratings 1..5, a time; the other columns stay."""
    typed = raw.withColumns({"rating": try_int(F.col("rating")), "time_stamp": F.col("time_stamp").try_cast("long")})
    return typed.where((F.length(F.trim("user_id")) > 0) & (F.length(F.trim("item_id")) > 0) & F.col("rating").between(1, 5) & F.col("time_stamp").isNotNull())


def clean_impressions(raw: DataFrame) -> DataFrame:
    """Ad impressions: user, item, label and time are there; label is the click."""
    return raw.dropna(subset=["user_id", "item_id", "label", "time_stamp"]).withColumn("day", day_of(F.col("time_stamp")))


def cast_columns(df: DataFrame, key: str, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Renamed and cast columns {new: (old, type)}; values that don't cast are null, rows without key are dropped."""
    out = df.select(*[F.col(old).try_cast(kind).alias(new) for new, (old, kind) in columns.items()])
    return out.where(F.col(key).isNotNull())


def parse_samples(raw: DataFrame) -> DataFrame:
    """Typed samples with ``parse_ok``: a row whose user, item, rating or time doesn't parse stays, flagged."""
    millis = to_millis(F.col("time_stamp"))
    typed = raw.withColumns({"rating_": try_int(F.col("rating")), "millis": millis})
    ok = (F.length(F.trim("user_id")) > 0) & (F.length(F.trim("item_id")) > 0) & F.col("rating_").isNotNull() & F.col("millis").isNotNull()
    return typed.withColumn("parse_ok", F.coalesce(ok, F.lit(False))).withColumn("rating", F.coalesce("rating_", F.lit(0))).drop("rating_")


def labelled(df: DataFrame, threshold: int = 4) -> DataFrame:
    return df.withColumn("label", F.when(F.col("rating") >= threshold, 1).otherwise(0))


def target(mode: str) -> Column:
    """The training target of a sample: the item (multi), the label (binary) or the rating."""
    return {"multi": F.col("item_id").try_cast("int"), "binary": F.col("label"), "rating": F.col("rating")}[mode]


def defaults(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Nulls of the named columns replaced."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()})
