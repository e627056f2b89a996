"""Text, CSV and prediction sources."""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_delimited(spark: SparkSession, path: str, sep: str, names: Sequence[str]) -> DataFrame:
    """Lines of a text file that split into exactly as many parts as there are names, trimmed strings."""
    parts = F.split("value", re.escape(sep), -1)
    lines = spark.read.text(path).select(parts.alias("p")).where(F.size("p") == len(names))
    return lines.select(*[F.trim(F.get("p", F.lit(i))).alias(n) for i, n in enumerate(names)])


def read_by_pattern(spark: SparkSession, path: str, pattern: str, names: Sequence[str]) -> DataFrame:
    """Lines that match a pattern in whole, its groups as columns; others are dropped."""
    lines = spark.read.text(path).where(F.col("value").rlike(f"^(?:{pattern})$"))
    return lines.select(*[F.regexp_extract("value", f"^(?:{pattern})$", i + 1).alias(n) for i, n in enumerate(names)])


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True, sep: str = ",") -> DataFrame:
    """CSV with a given schema, in one pass; headerless TSV with header=False and sep="\\t"."""
    return spark.read.schema(schema).csv(path, header=header, sep=sep)


def read_predictions(spark: SparkSession, path: str, fmt: str, **options: str) -> DataFrame:
    """Predictions as Parquet, CSV or TFRecord; score and label come as doubles whatever the writer stored."""
    if fmt == "tfrecords":
        from recspark.sources.tfrecord import read_tfrecord

        df = read_tfrecord(spark, path, **options)
    else:
        df = spark.read.options(**options).format(fmt).load(path)
    return df.withColumns({c: F.col(c).cast("double") for c in ("score", "label", "target") if c in df.columns})


def read_prediction_log(spark: SparkSession, path: str, sep: str = "|") -> DataFrame:
    """Lines ``user:item:reqdt:reqid:device:country:label`` and a score behind ``sep``; malformed lines are dropped."""
    names = ("user_id", "item_id", "req_dt", "request_id", "device", "country", "label")
    halves = F.split("value", re.escape(sep), -1)
    lines = spark.read.text(path).select(halves.alias("h")).where(F.size("h") == 2)
    lines = lines.select(F.split(F.get("h", F.lit(0)), ":", -1).alias("k"), F.get("h", F.lit(1)).try_cast("double").alias("score")).where(F.size("k") == len(names))
    out = lines.select(*[F.get("k", F.lit(i)).alias(n) for i, n in enumerate(names)], "score")
    return out.withColumn("label", F.col("label").try_cast("double")).where("score is not null and label is not null")


def scored_table(df: DataFrame, day: str, scene_id: str, algo: str, score_path: str = "$.score") -> DataFrame:
    """Rows of one day, scene and algorithm with a score from a JSON column ``extra``; the filters reach the partitions."""
    rows = df.where((F.col("day") == day) & (F.col("scene_id") == scene_id) & (F.col("algo") == algo))
    return rows.withColumn("score", F.get_json_object("extra", score_path).try_cast("double"))


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Quality reports of an earlier run, as JSON lines."""
    return spark.read.schema("stage string, total_count long, name string, type string, null_count long, null_ratio double, cardinality long, min string, max string, mean double, stddev double").json(path)


def listed_days(df: DataFrame, column: str = "day") -> DataFrame:
    """The values of a partition column, one row each, as strings, from the paths of a table's files: no file is opened.

    ``df`` is the table as read, without further operators. Null partitions are left out; a table without files gives no rows.
    """
    found = (re.search(f"/{re.escape(column)}=([^/]+)/", path) for path in df.inputFiles())
    # the partition's folder escapes its value, and the file's URI escapes the folder
    values = sorted({unquote(unquote(m[1])) for m in found if m} - {"__HIVE_DEFAULT_PARTITION__"})
    return df.sparkSession.createDataFrame([(v,) for v in values], f"`{column}` string")


def latest_day(df: DataFrame, day: str, column: str = "day") -> DataFrame:
    """The largest day not after ``day``, as one row (day); null if there is none. Of a partitioned table, give ``listed_days``."""
    return df.where(F.col(column) <= day).agg(F.max(column).alias("day"))


def last_day(df: DataFrame, column: str = "day") -> DataFrame:
    """The largest day of all, as one row (day). Of a partitioned table, give ``listed_days``."""
    return df.agg(F.max(column).alias("day"))


def partition_sample(df: DataFrame, day: str, n: int, column: str = "day") -> DataFrame:
    """``n`` rows of one day, any of them; the filter reaches the partition and reading stops when they are found."""
    return df.where(F.col(column) == day).limit(n)
