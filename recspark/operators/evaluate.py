"""Ranking metrics from (label, score), without a sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recspark.functions.names import fresh
from recspark.sources.scratch import written


def _wins(preds: DataFrame, group: list[str], label: str, score: str) -> tuple[DataFrame, Column, Column, Column]:
    """One row a group and score, range-partitioned and written, and for it positives, negatives and won pairs, ties as half.

    Negatives below a score are a running sum within the partition plus the group's sums of the partitions before, so
    that a giant group is spread over many tasks.
    """
    s, pos, neg, part, less, base, m = fresh(group, "s", "pos", "neg", "part", "less", "base", "m")
    per = preds.groupBy(*group, F.col(score).alias(s)).agg(F.count_if(F.col(label) > 0.5).alias(pos), F.count_if(F.col(label) <= 0.5).alias(neg))
    n = int(preds.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(per.repartitionByRange(n, *group, s).withColumn(part, F.spark_partition_id()), "scores")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(*group, part).agg(F.sum(neg).alias(m))
    bases = sums.select(*group, part, F.coalesce(F.sum(m).over(before(Window.partitionBy(*group).orderBy(part))), F.lit(0)).alias(base))
    inside = F.coalesce(F.sum(neg).over(before(Window.partitionBy(*group, part).orderBy(s))), F.lit(0))
    on = F.lit(True)
    for c in (*group, part):
        on = on & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    j = ranged.withColumn(less, inside).alias("a").join(bases.alias("b"), on)
    j = j.select(*[F.col(f"a.{c}") for c in (*group, pos, neg, less)], F.col(f"b.{base}"))
    return j, F.col(pos), F.col(neg), F.col(pos) * (F.col(base) + F.col(less) + F.col(neg) / 2.0)


def _area(pos: Column, neg: Column, wins: Column) -> Column:
    pairs = F.sum(pos).cast("double") * F.sum(neg).cast("double")
    return F.round(F.coalesce(F.when(pairs > 0, F.sum(wins) / pairs), F.lit(0.5)), 9).alias("auc")


def auc(preds: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row (auc): the chance that a positive scores above a negative, ties counting half; 0.5 with one class only."""
    j, pos, neg, wins = _wins(preds, [], label, score)
    return j.agg(_area(pos, neg, wins))


def group_auc(preds: DataFrame, group: list[str], label: str = "label", score: str = "score") -> DataFrame:
    """group, n, clicks, auc of every group; 0.5 for a group with one class. A null group is a group."""
    j, pos, neg, wins = _wins(preds, group, label, score)
    return j.groupBy(*group).agg((F.sum(pos) + F.sum(neg)).alias("n"), F.sum(pos).alias("clicks"), _area(pos, neg, wins))


def gauc(preds: DataFrame, group: list[str], variant: str = "two_class") -> DataFrame:
    """One row (gauc, n_groups): the mean of the groups' AUC.

    two_class: groups with both classes, weighted by clicks, or by size where there is no click; all_groups: every
    group, one-class groups at 0.5, weighted by size. Without groups the value is 0.
    """
    g = group_auc(preds, group)
    if variant == "two_class":
        g = g.where((F.col("clicks") > 0) & (F.col("clicks") < F.col("n"))).withColumn("w", F.col("clicks"))
    else:
        g = g.withColumn("w", F.col("n"))
    return g.agg(F.round(F.coalesce(F.sum(F.col("auc") * F.col("w")) / F.sum("w"), F.lit(0.0)), 6).alias("gauc"), F.count(F.lit(1)).alias("n_groups"))


def top_groups(preds: DataFrame, group: list[str], k: int = 5) -> DataFrame:
    return group_auc(preds, group).orderBy(F.col("auc").desc(), *group).limit(k)


def with_segments(preds: DataFrame, segments: DataFrame, key: str, day: str) -> DataFrame:
    """Predictions with their user's segment of the day before, null without one."""
    before = segments.where(F.col("day") == F.date_format(F.date_sub(F.lit(day).cast("date"), 1), "yyyy-MM-dd")).drop("day")
    return preds.join(before, key, "left")


def auc_check(preds: DataFrame) -> float:
    """The area by Spark ML's evaluator, as a cross-check."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    return BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(preds)
