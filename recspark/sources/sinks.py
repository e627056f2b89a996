"""Sinks: flat files, encoded tables, splits, reports, vocabularies and single partitions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recspark.operators.vocab import STATS, from_sums


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, sep="\t")


def shuffled(df: DataFrame, key: str, partitions: int, seed: int = 42) -> DataFrame:
    """Rows dealt at random over ``partitions`` files and in random order there; the key and seed decide."""
    return df.repartition(partitions, F.xxhash64(F.lit(seed), key)).sortWithinPartitions(F.xxhash64(key, F.lit(seed + 1)))


def write_splits(df: DataFrame, path: str) -> None:
    """Parquet in folders split=train, val, test; rows that didn't parse are left out."""
    rows = df.where("parse_ok") if "parse_ok" in df.columns else df
    rows.write.mode("overwrite").partitionBy("split").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report of one row a column, as a single JSON-lines file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def write_partition(df: DataFrame, path: str, columns: list[str]) -> None:
    """Overwrites only the partitions that ``df`` has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def write_vocabulary(pos_map: DataFrame, target_map: DataFrame, dims: DataFrame, path: str) -> None:
    """Tables pos_map and target_map, pos_dim as CSV."""
    pos_map.write.mode("overwrite").partitionBy("field_index").parquet(f"{path}/pos_map")
    target_map.write.mode("overwrite").parquet(f"{path}/target_map")
    dims.coalesce(1).write.mode("overwrite").csv(f"{path}/pos_dim", header=True)


#: What a vocabulary is joined by.
VOCABULARY_KEY = ("field_index", "field_type", "key")


def save_vocabulary(pos_map: DataFrame, name: str, path: str, buckets: int | None = None) -> DataFrame:
    """The vocabulary as catalog table ``name`` at ``path``, one sorted file a bucket of its key, and read from there.

    Builds and reports that are given it shuffle their new keys to its buckets, and the vocabulary stays where it is; with fewer
    buckets than ``spark.sql.shuffle.partitions``, their default, Spark may rather shuffle it for more tasks. An existing table of the name
    is an error, since ``pos_map`` may be read from it: an addition goes to a new name and path.
    """
    spark = pos_map.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = pos_map.repartition(n, *VOCABULARY_KEY)
    dealt.write.format("parquet").option("path", path).bucketBy(n, *VOCABULARY_KEY).sortBy(*VOCABULARY_KEY).saveAsTable(name)
    return spark.table(name)


def vocabulary_json(pos_map: DataFrame) -> DataFrame:
    """(field_index, field_type, json): the entries of each field as one JSON text, for consumers that want a file a field."""
    entry = F.struct("pos", "key", "cnt", "sum", "sum_sq", "mean", "m2")
    return pos_map.groupBy("field_index", "field_type").agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("json"))


def vocabulary_from_json(fields: DataFrame) -> DataFrame:
    """The vocabulary in (field_index, field_type, json), ready to be added to.

    Entries without mean and m2 get them from their sums; without sums they count as values of 1.
    """
    entry = "array<struct<pos:bigint,key:string,cnt:bigint,sum:double,sum_sq:double,mean:double,m2:double>>"
    e = fields.select("field_index", "field_type", F.explode(F.from_json("json", entry)).alias("e")).select("field_index", "field_type", "e.*")
    e = e.withColumns({"sum": F.coalesce("sum", F.col("cnt").cast("double")), "sum_sq": F.coalesce("sum_sq", F.col("cnt").cast("double"))})
    rebuilt = from_sums(F.col("cnt"), F.col("sum"), F.col("sum_sq"))
    known = F.col("mean").isNotNull() & F.col("m2").isNotNull()
    stats = {c: F.when(known, F.col(c)).otherwise(rebuilt[c]) for c in ("mean", "m2")}
    return e.withColumns(stats).select("field_index", "field_type", "key", "pos", *STATS)


def read_vocabulary(spark, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    dims = spark.read.schema("field_name string, field_index int, field_type int, dim long").csv(f"{path}/pos_dim", header=True)
    return spark.read.parquet(f"{path}/pos_map"), spark.read.parquet(f"{path}/target_map"), dims
