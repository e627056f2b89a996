"""Interaction, item, user and prediction views over the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.functions.scalars import epoch_seconds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, item_id, rating, time_stamp, day of every ordered line."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("item_id"),
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("rating"),
        (epoch_seconds(F.col("o_orderdate")) + F.col("l_linenumber")).cast("long").alias("time_stamp"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
    )


def event_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sample_id, user_id, item_id, rating, time_stamp, day of every event."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("sample_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.get_json_object("props", "$.k").alias("item_id"),
        (F.lit(1) + F.pmod(F.floor("value"), F.lit(5))).cast("int").alias("rating"),
        epoch_seconds(F.col("ts")).alias("time_stamp"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("item_id"), F.col("p_name").alias("title"), F.split("p_name", " ").alias("genres"), F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("price")
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select(  # nations are a fixed list
        F.col("c_custkey").cast("string").alias("user_id"),
        F.when(F.col("c_mktsegment") < "F", "F").otherwise("M").alias("gender"),
        F.col("c_nationkey").cast("string").alias("age"),
        F.col("n_regionkey").cast("string").alias("occupation"),
        F.lpad(F.col("c_custkey").cast("string"), 5, "0").alias("zip_code"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """label, score, grp, lang, doc_id of labelled documents."""
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "source", "lang")
    return table(spark, sf_dir, "labels").join(d, "doc_id").select(
        "doc_id", F.col("quality").cast("double").alias("label"), F.col("n_chars").cast("double").alias("score"), F.col("source").alias("grp"), "lang"
    )
