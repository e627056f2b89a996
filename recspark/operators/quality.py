"""Column quality reports, drift between them, and stage reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.sources.scratch import written

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def quality_report(df: DataFrame, stage: str, approximate: bool = False) -> DataFrame:
    """A row per scalar column: stage, total_count, name, type, null_count, null_ratio, cardinality, min, max, mean, stddev.

    One aggregation for all columns. Strings have a cardinality, numbers the rest; an empty table gives no rows.
    """
    cols = [(c, t) for c, t in df.dtypes if t == "string" or t in NUMERIC or t.startswith("decimal")]
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    aggs = [F.count(F.lit(1)).alias("total")]
    for c, t in cols:
        q, num = F.col(f"`{c}`"), t != "string"
        v = q.cast("double")
        none = F.lit(None).cast("double")
        aggs.append(F.struct(
            F.lit(c).alias("name"), F.lit("numeric" if num else "string").alias("type"), F.count_if(q.isNull()).alias("null_count"),
            (F.lit(None).cast("long") if num else distinct(q)).alias("cardinality"),
            (F.min(v) if num else none).alias("min"), (F.max(v) if num else none).alias("max"), (F.avg(v) if num else none).alias("mean"), (F.stddev_samp(v) if num else none).alias("stddev"),
        ).alias(f"c_{len(aggs)}"))
    one = df.agg(*aggs).where("total > 0")
    long = one.select("total", F.explode(F.array(*[F.col(f"c_{i + 1}") for i in range(len(cols))])).alias("r"))
    return long.select(
        F.lit(stage).alias("stage"), F.col("total").alias("total_count"), "r.name", "r.type", "r.null_count", F.round(F.col("r.null_count") / F.col("total"), 6).alias("null_ratio"),
        "r.cardinality", "r.min", "r.max", "r.mean", "r.stddev",
    )


def drift_report(now: DataFrame, before: DataFrame, count: float = 0.2, null: float = 0.05, mean: float = 0.5) -> DataFrame:
    """name, metric, prev, curr, warn for the columns of both reports: row count, null ratio, mean."""
    j = now.alias("n").join(before.alias("p"), "name")
    lines = [
        ("count", "total_count", F.abs(F.col("n.total_count") - F.col("p.total_count")) / F.greatest(F.col("p.total_count"), F.lit(1)) > count),
        ("null_ratio", "null_ratio", F.abs(F.col("n.null_ratio") - F.col("p.null_ratio")) > null),
        ("mean", "mean", (F.col("p.mean") != 0) & (F.abs(F.col("n.mean") - F.col("p.mean")) / F.abs(F.col("p.mean")) > mean)),
    ]
    rows = [F.struct(F.lit(m).alias("metric"), F.col(f"p.{c}").cast("double").alias("prev"), F.col(f"n.{c}").cast("double").alias("curr"), F.coalesce(w, F.lit(False)).alias("warn")) for m, c, w in lines]
    return j.select("name", F.explode(F.array(*rows)).alias("r")).select("name", "r.*").where("prev is not null and curr is not null")


def stage_report(df: DataFrame, stage: str, target: str = "target") -> DataFrame:
    """stage, total, valid, valid_share, n_targets of parsed samples."""
    valid = F.count_if("parse_ok")
    return df.agg(F.count(F.lit(1)).alias("total"), valid.alias("valid"), F.count_distinct(F.when(F.col("parse_ok"), F.col(target))).alias("n_targets")).select(
        F.lit(stage).alias("stage"), "total", "valid", F.round(F.col("valid") / F.greatest(F.col("total"), F.lit(1)), 6).alias("valid_share"), "n_targets"
    )


def top_targets(df: DataFrame, k: int = 5, target: str = "target") -> DataFrame:
    return df.where("parse_ok").groupBy(target).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.col("cnt").desc(), target).limit(k)


def label_distribution(df: DataFrame, label: str = "label", k: int | None = None) -> DataFrame:
    """label, cnt, share, the most frequent first; the k first if asked for."""
    counts = written(df.groupBy(label).agg(F.count(F.lit(1)).alias("cnt")), "labels")
    total = counts.agg(F.sum("cnt").alias("__total"))  # one row
    shares = counts.crossJoin(F.broadcast(total)).withColumn("share", F.round(F.col("cnt") / F.col("__total"), 6)).drop("__total")
    return shares.orderBy(F.col("cnt").desc(), label).limit(k) if k else shares


def feature_coverage(df: DataFrame) -> DataFrame:
    """column, filled, coverage of the encoded columns: the share of rows that aren't null, in one aggregation."""
    cols = [c for c in df.columns if c.endswith(("_raw", "_index", "_value"))]
    one = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("filled")) for c in cols])
    return one.select("n", F.explode(rows).alias("r")).select("r.column", "r.filled", F.round(F.col("r.filled") / F.greatest("n", F.lit(1)), 6).alias("coverage"))
