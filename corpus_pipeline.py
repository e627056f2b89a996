"""The corpus pipeline: its stages in order, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recspark.functions.names import fresh
from recspark.llm import jaccard_join, mixing, pieces, quality_model, rule_lists
from recspark.sources.scratch import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned decision list.

    Each row is judged by its own text alone, so null and repeated ids make no difference; null and empty texts fail the base rules.
    Other columns pass as they are, whatever their names. An empty table gives no rows.
    """
    return rule_lists.kept_rows(docs, table(spark, sf_dir, "labels"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.3 or more. It learns from the labelled documents of the table, rejected ones included.

    Each row is judged by its own whole text; null and empty texts get the model's bias alone, repeated rows are judged each. Other
    columns pass as they are, whatever their names. An empty table gives no rows.
    """
    model = quality_model.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    (score,) = fresh(docs.columns, "score")
    return quality_model.score(docs, model, score).where(F.col(score) >= 0.3).drop(score)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of rows whose five-word shingles are alike to 0.8 or more: that with the smallest id, null ids last.

    Rows are told apart by a number of their own, so rows of null or repeated ids are grouped and chosen like any other.
    A row without words is a group of its own. Other columns pass as they are, whatever their names. An empty table gives no rows.
    """
    row, doc_id, least = fresh(docs.columns, "row", "named_id", "least")
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = jaccard_join.join_groups(rows.select(F.col(row).alias("doc_id"), "text"), n=5, percent=80)
    named = groups.select(F.col("doc_id").alias(row), "component_id").join(rows.select(row, F.col("doc_id").alias(doc_id)), row)
    smallest = F.min(F.struct(F.col(doc_id).isNull().alias("unnamed"), doc_id, row)).alias(least)
    first = written(named.groupBy("component_id").agg(smallest).select(f"{least}.{row}"), "first")
    first = F.broadcast(first) if first.count() <= jaccard_join.BROADCAST_IDS else first
    return rows.join(first, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Null sources are one source, null and empty texts have no words and aren't taken; equal rows are decided together. Other columns
    pass as they are, whatever their names. An empty table gives no rows.
    """
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document's best segmentation, and its text decoded from them.

    Each row is encoded by itself, however long; null and empty texts have no ids and come back empty. Columns ids, score and losses of
    the input are replaced, others pass as they are. An empty table gives no rows.
    """
    return pieces.encode_and_decode(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixed_sources),
    ("SentencePiece encoding and decoding", encoded),
]

#: The stages learn, hash and round; SQL expresses none of that. Tests hold what the stages keep on small tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
